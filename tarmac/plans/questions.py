"""The business questions of the bookings mart.

Each question is a function ``BookingTables -> DataFrame`` returning rows
``(id INT, response STRING)``, i.e. exactly the rows it contributes to the
results mart. Catalyst sees each question as one plan (scalar subqueries included).
Building one triggers no Spark action, except for q12, which numbers the cities
in a small eager job and checkpoints them (``operators.dense_index``).

Semantics follow the SQL version of the source questions, with these
explicit decisions:

* NULL never wins an extreme (min or max) question.
* ``a || b`` is NULL if any part is NULL (q04, q09, q12); q08 concatenates
  with NULL parts as empty strings and keeps every separator.
* Money is DECIMAL end to end; time spans are whole seconds (BIGINT).
* Integer results use truncating integral division (``div``).
* Day buckets use the session time zone; q19 also has a shifted form.
* q21 breaks a tie at the last place by city name.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import constants as K
from tarmac.functions import concat_empty, concat_strict, day, hms, int_div, shifted_day, span_seconds
from tarmac.operators import (
    COPIES,
    answer,
    extreme_rows,
    keys_with_size,
    missing_pairs,
    per_flight,
    per_ticket,
    roll_up,
    splittable,
    top_value,
    unreached_from,
    with_ticket,
)
from tarmac.sources.tables import DAY_PARTITION_COLUMN, BookingTables



def _sep():
    return F.lit(K.RESPONSE_SEPARATOR)


def _on_day(flights_v: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Rows whose actual departure falls on day ``first`` (or in [first, last]).

    On the day-partitioned copy the same predicate is also put on the
    partition column, so the scan reads only the matching directories.
    """
    last = last or first
    f = flights_v
    if DAY_PARTITION_COLUMN in f.columns:
        f = f.where(F.col(DAY_PARTITION_COLUMN).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return f.where(day("actual_departure").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


# ---------------------------------------------------------------- tickets only

def booking_facts(t: BookingTables) -> DataFrame:
    """Per booking: ``n`` (tickets), ``numbered`` (tickets with a ticket_no)
    and ``repeats`` (passenger names occurring more than once). q03 reads it;
    the mart stores it once and q01-q04 all read the stored copy.

    Two partial aggregations, per (booking, name) and then per booking: a
    booking holding a third of all tickets is spread over its names first
    and reaches the second shuffle as one partial row per map task.
    """
    if "booking_facts" in t.derived:
        return t.derived["booking_facts"]
    names = t.tickets.groupBy("book_ref", "passenger_name").agg(
        F.count(F.lit(1)).alias("c"), F.count("ticket_no").alias("c_numbered")
    )
    return names.groupBy("book_ref").agg(
        F.sum("c").alias("n"),
        F.sum("c_numbered").alias("numbered"),
        F.count_if(F.col("c") > 1).alias("repeats"),
    )


def booking_sizes(t: BookingTables) -> DataFrame:
    """Per booking: ``n`` and ``numbered`` only (q01, q02, q04). One partial
    aggregation (a hot booking collapses map-side); the stored booking facts
    when the mart has written them."""
    if "booking_facts" in t.derived:
        return t.derived["booking_facts"].select("book_ref", "n", "numbered")
    return t.tickets.groupBy("book_ref").agg(
        F.count(F.lit(1)).alias("n"), F.count("ticket_no").alias("numbered")
    )


def q01_max_people_per_booking(t: BookingTables) -> DataFrame:
    """Largest number of tickets in one booking."""
    return answer(top_value(booking_sizes(t), "n", "max_n"), 1, "max_n")


def q02_bookings_above_avg_size(t: BookingTables) -> DataFrame:
    """Number of bookings with more tickets (counted by ticket_no) than the
    average booking."""
    sizes = booking_sizes(t)
    mean = sizes.agg(F.avg("numbered")).scalar()
    above = sizes.where(F.col("numbered") > mean).agg(F.count(F.lit(1)).alias("bookings"))
    return answer(above, 2, "bookings")


def q03_repeat_names_in_max_bookings(t: BookingTables) -> DataFrame:
    """Among the largest bookings, the number of (booking, passenger name)
    groups that occur more than once (per-booking repeat counts summed over
    the largest bookings; nothing joins back to the tickets)."""
    # rows without a booking count for the maximum, but are in no booking
    largest = extreme_rows(booking_facts(t), "n").where(F.col("book_ref").isNotNull())
    return answer(largest.agg(F.coalesce(F.sum("repeats"), F.lit(0)).alias("groups")), 3, "groups")


def q04_contacts_bookings_of_three(t: BookingTables, size: int = K.Q04_BOOKING_SIZE) -> DataFrame:
    """``book_ref|passenger_id|passenger_name|contact_data`` for every ticket
    of a booking with exactly ``size`` tickets: booking sizes (a partial
    aggregate), then a semi join of the tickets with the qualifying bookings.
    Both sides of the join are shuffled for it, so a booking that holds a large
    share of all tickets is split over tasks by AQE (see ``splittable``)."""
    sizes = t.derived.get("booking_facts")
    if sizes is None:
        sizes = splittable(t.tickets, "book_ref", n=F.count(F.lit(1)))
    keys = sizes.where(F.col("n") == size).select("book_ref")
    rows = t.tickets.join(keys, "book_ref", "left_semi")
    return answer(
        rows, 4,
        concat_strict("book_ref", _sep(), "passenger_id", _sep(), "passenger_name", _sep(), "contact_data"),
    )


# ------------------------------------------------------- tickets x legs x flights
#
# Shared facts. The questions below read the fact table (ticket_flights)
# only through two aggregates: per ticket (q05-q09) and per flight (q15,
# q18). A question run alone computes them on the fly, pruned to the columns
# it needs; the mart writes the totals of q05-q09 and the flight facts once and
# every question reads the stored copy (see tarmac.plans.mart.stage_facts).

PASSENGER = ["passenger_id", "passenger_name", "contact_data"]
TICKET_COLUMNS = ["book_ref", "ticket_no", *PASSENGER]


def flight_attributes(t: BookingTables) -> DataFrame:
    """Per flight_id of ``flights`` or ``flights_v``: ``live`` (rows of
    ``flights`` not cancelled), ``known`` (rows of ``flights_v``) and ``secs``
    (seconds in the air on arrived rows of ``flights_v``), each NULL if there is
    none. Copies of a flight row count each, as in a flat join, and collapse
    map-side."""
    listed = t.flights.where(F.col("status") != K.STATUS_CANCELLED).select(
        "flight_id", F.lit(1).alias("live"), F.lit(None).cast("int").alias("known"),
        F.lit(None).cast("bigint").alias("secs"))
    arrived = F.col("status") == K.STATUS_ARRIVED
    seen = t.flights_v.select(
        "flight_id", F.lit(None).cast("int").alias("live"), F.lit(1).alias("known"),
        F.when(arrived, span_seconds("actual_departure", "actual_arrival")).alias("secs"))
    return splittable(listed.unionByName(seen), "flight_id", live=F.sum("live"), known=F.sum("known"), secs=F.sum("secs"))


def ticket_facts(t: BookingTables) -> DataFrame:
    """Per ticket, over its legs: ``legs`` (count of legs on flights in
    ``flights_v``), ``spend`` (amount on flights that ``flights`` lists as not
    cancelled) and ``airtime`` (seconds in the air on arrived flights).

    One join of the fact table with the flight attributes, then one
    partial/final aggregation per ticket: the fact-sized data is reduced to
    ticket-sized before the ticket join. A ticket whose legs all fail a
    question's filter gets NULL, which never wins an extreme.
    """
    legs = t.ticket_flights.select("ticket_no", "flight_id", "amount").join(flight_attributes(t), "flight_id")
    return per_ticket(
        legs,
        legs=F.sum("known"),
        spend=F.sum(F.col("amount") * F.col("live").cast("decimal(10,0)")),
        airtime=F.sum("secs"),
    )


def ticket_rows(t: BookingTables) -> DataFrame:
    """Ticket rows with their per-ticket facts (shared by q05-q09)."""
    return with_ticket(t.tickets, ticket_facts(t), TICKET_COLUMNS)


# The grouping sets of q05-q09, by name.
TICKET_SETS = {
    "booking": ["book_ref"],
    "ticket": ["book_ref", "ticket_no"],
    "passenger_id": ["passenger_id"],
    "passenger": PASSENGER,
}


def ticket_totals(t: BookingTables) -> DataFrame:
    """``legs``, ``spend`` and ``airtime`` summed for every grouping set of
    q05-q09 at once (``GROUPING SETS``: the ticket rows are made and read once,
    expanded and aggregated with one shuffle), with the set's name in ``set``."""
    columns = list(dict.fromkeys(c for keys in TICKET_SETS.values() for c in keys))
    sums = ticket_rows(t).groupingSets([[F.col(c) for c in keys] for keys in TICKET_SETS.values()], *[F.col(c) for c in columns]).agg(
        F.grouping_id(*columns).alias("_set"), *[F.sum(c).alias(c) for c in ("legs", "spend", "airtime")])
    name = F.lit(None).cast("string")
    for n, keys in TICKET_SETS.items():  # a set's number has a bit for each column it leaves out, the first highest
        number = sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys)
        name = F.when(F.col("_set") == number, F.lit(n)).otherwise(name)
    return sums.withColumn("set", name).drop("_set")


def totals_by(t: BookingTables, name: str, /, **sums: str) -> DataFrame:
    """The ticket facts summed up to the grouping set ``name``: read from the
    totals of all sets when the mart has stored them."""
    keys = TICKET_SETS[name]
    if "ticket_totals" in t.derived:
        rows = t.derived["ticket_totals"].where(F.col("set") == name)
        return rows.select(*keys, *[F.col(c).alias(n) for n, c in sums.items()])
    return roll_up(ticket_rows(t), keys, **sums)


def passenger_totals(t: BookingTables) -> DataFrame:
    """Per passenger (id, name, contact): total ``spend`` and ``airtime``
    (q08 and q09; each keeps only the column it reads)."""
    return totals_by(t, "passenger", spend="spend", airtime="airtime")


def flight_facts(t: BookingTables) -> DataFrame:
    """Per flight: ``legs`` (count) and ``revenue`` (amount), aggregated on
    the fact table before meeting the flights dimension (q15, q18). A flight
    carrying a third of all legs is one partial row per map task."""
    if "flight_facts" in t.derived:
        return t.derived["flight_facts"]
    return per_flight(t.ticket_flights, legs=F.count(F.lit(1)), revenue=F.sum("amount"))


def _max_legs(t: BookingTables, name: str, qid: int) -> DataFrame:
    per_key = totals_by(t, name, n="legs")
    return answer(top_value(per_key, "n", "max_n"), qid, "max_n")


def q05_max_flights_per_booking(t: BookingTables) -> DataFrame:
    """Largest number of flight legs in one booking (legs of known flights)."""
    return _max_legs(t, "booking", 5)


def q05_max_legs_no_flight_check(t: BookingTables) -> DataFrame:
    """Variant of q05 counting every leg, known flight or not."""
    counts = per_ticket(t.ticket_flights, legs=F.count(F.lit(1)))
    per_key = roll_up(with_ticket(t.tickets, counts, ["book_ref"]), ["book_ref"], n="legs")
    return answer(top_value(per_key, "n", "max_n"), 5, "max_n")


def q06_max_flights_per_ticket(t: BookingTables) -> DataFrame:
    """Largest number of flight legs on one ticket of a booking."""
    return _max_legs(t, "ticket", 6)


def q07_max_flights_per_passenger(t: BookingTables) -> DataFrame:
    """Largest number of flight legs of one passenger."""
    return _max_legs(t, "passenger_id", 7)


def q08_min_spend_passengers(t: BookingTables) -> DataFrame:
    """Passenger(s) with the smallest total ticket amount over flights that
    are not cancelled, as ``id|name|contact|total``."""
    cheapest = extreme_rows(passenger_totals(t), "spend", largest=False)
    return answer(
        cheapest, 8,
        concat_empty("passenger_id", _sep(), "passenger_name", _sep(), "contact_data", _sep(), "spend"),
    )


def q09_max_airtime_passengers(t: BookingTables) -> DataFrame:
    """Passenger(s) with the most time in the air on arrived flights, as
    ``id|name|contact|hh:mm:ss``."""
    longest = extreme_rows(passenger_totals(t), "airtime")
    return answer(
        longest, 9,
        concat_strict("passenger_id", _sep(), "passenger_name", _sep(), "contact_data", _sep(),
                      hms("airtime")),
    )


# ----------------------------------------------------------------- network

def q10_cities_multi_airport(t: BookingTables) -> DataFrame:
    """Cities with more than one airport."""
    return answer(keys_with_size(t.airports, "city", lambda n: n > 1), 10, "city")


def q11_fewest_direct_cities(t: BookingTables) -> DataFrame:
    """Departure cities with the fewest distinct direct destinations."""
    reach = t.routes.groupBy("departure_city").agg(F.count_distinct("arrival_city").alias("k"))
    return answer(extreme_rows(reach, "k", largest=False), 11, "departure_city")


def q11_fewest_direct_cities_by_arrival(t: BookingTables) -> DataFrame:
    """Mirror form: arrival cities with the fewest distinct direct origins."""
    reach = t.routes.groupBy("arrival_city").agg(F.count_distinct("departure_city").alias("k"))
    return answer(extreme_rows(reach, "k", largest=False), 11, "arrival_city")


def q11_fewest_departures(t: BookingTables) -> DataFrame:
    """Loose form: departure cities with the fewest flights."""
    counts = t.flights_v.groupBy("departure_city").agg(F.count(F.lit(1)).alias("n"))
    return answer(extreme_rows(counts, "n", largest=False), 11, "departure_city")


def q12_unconnected_city_pairs(t: BookingTables) -> DataFrame:
    """Pairs ``c1|c2`` of airport cities, c1 < c2, with no flight c1 -> c2
    (a flight c2 -> c1 does not connect the pair)."""
    pairs = missing_pairs(
        t.airports, "city", t.flights_v, "departure_city", "arrival_city", "c1", "c2"
    )
    return answer(pairs, 12, concat_strict("c1", _sep(), "c2"))


def q13_unreachable_from_city(t: BookingTables, origin: str = K.CITY_MOSCOW) -> DataFrame:
    """Airport cities with no direct flight from ``origin``."""
    cities = unreached_from(
        t.airports, "city", t.flights_v, "departure_city", "arrival_city", origin, "c2"
    )
    return answer(cities, 13, "c2")


# ------------------------------------------------------------------ flights

def _models(t: BookingTables, per_code: DataFrame, qid: int) -> DataFrame:
    best = extreme_rows(per_code, "n").select("aircraft_code")
    return answer(t.aircrafts.join(best, "aircraft_code"), qid, "model")


def q14_model_most_flights(t: BookingTables) -> DataFrame:
    """Aircraft model(s) with the most arrived flights."""
    arrived = t.flights_v.where(F.col("status") == K.STATUS_ARRIVED)
    return _models(t, arrived.groupBy("aircraft_code").agg(F.count(F.lit(1)).alias("n")), 14)


def q15_model_most_passengers(t: BookingTables) -> DataFrame:
    """Aircraft model(s) with the most ticket legs on arrived flights
    (legs counted per flight first, then joined to flights)."""
    # copies of a flight row count once each (flat-join semantics) but cross
    # the shuffle as one row with a copy count
    arrived = (
        t.flights_v.where(F.col("status") == K.STATUS_ARRIVED)
        .groupBy("flight_id", "aircraft_code").agg(F.count(F.lit(1)).alias(COPIES))
    )
    per_code = roll_up(flight_facts(t).join(arrived, "flight_id"), ["aircraft_code"], n="legs")
    return _models(t, per_code, 15)


def q16_schedule_deviation_minutes(t: BookingTables) -> DataFrame:
    """|sum over arrived flights of (planned - actual) duration|, in whole
    minutes (seconds summed exactly, then integral division by 60)."""
    arrived = t.flights_v.where(F.col("status") == K.STATUS_ARRIVED)
    delta = span_seconds("scheduled_departure", "scheduled_arrival") - span_seconds(
        "actual_departure", "actual_arrival"
    )
    total = arrived.agg(F.abs(F.sum(delta)).alias("seconds"))
    return answer(total.select(int_div("seconds", 60).alias("minutes")), 16, "minutes")


def q17_destinations_on_day(t: BookingTables, origin: str = K.CITY_ST_PETERSBURG,
                            on: str = K.Q17_DAY) -> DataFrame:
    """Cities flown to from ``origin`` by flights that departed on day ``on``."""
    flown = _on_day(t.flights_v, on).where(
        (F.col("departure_city") == origin)
        & F.col("status").isin(K.STATUS_ARRIVED, K.STATUS_DEPARTED)
    )
    return answer(flown.select("arrival_city").distinct(), 17, "arrival_city")


def q18_top_revenue_flights(t: BookingTables) -> DataFrame:
    """Flight(s) with the largest total ticket amount, not cancelled.

    Amounts are summed per flight on the fact table first; only then does the
    (flight-sized) result meet the flights. Copies of a flight row count each,
    as in q15 and the flat join.
    """
    flown = (t.flights.where(F.col("status") != K.STATUS_CANCELLED)
             .groupBy("flight_id").agg(F.count(F.lit(1)).alias(COPIES)))
    per_id = roll_up(flight_facts(t).join(flown, "flight_id"), ["flight_id"], total="revenue")
    return answer(extreme_rows(per_id, "total"), 18, "flight_id")


def _quietest(t: BookingTables, bucket, qid: int) -> DataFrame:
    departed = t.flights_v.where(
        (F.col("status") != K.STATUS_CANCELLED) & F.col("actual_departure").isNotNull()
    )
    per_day = departed.groupBy(bucket.alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return answer(extreme_rows(per_day, "n", largest=False), qid, "d")


def q19_quietest_days(t: BookingTables) -> DataFrame:
    """Day(s) with the fewest departures (not cancelled, departure known)."""
    return _quietest(t, day("actual_departure"), 19)


def q19_quietest_days_shifted(t: BookingTables, zone: str = K.Q19_SOURCE_ZONE) -> DataFrame:
    """q19 after reading departures as ``zone`` wall-clock time moved to UTC."""
    return _quietest(t, shifted_day("actual_departure", zone), 19)


def q20_avg_departures_per_day(t: BookingTables, origin: str = K.CITY_MOSCOW,
                               first: str = K.Q20_FIRST_DAY, last: str = K.Q20_LAST_DAY) -> DataFrame:
    """Departures (departed or arrived) from ``origin`` with departure day in
    [first, last], divided by the number of days with integral division."""
    days = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    flown = _on_day(t.flights_v, first, last).where(
        (F.col("departure_city") == origin)
        & F.col("status").isin(K.STATUS_DEPARTED, K.STATUS_ARRIVED)
    )
    count = flown.agg(F.count("flight_id").alias("n"))
    return answer(count.select(int_div("n", days).alias("per_day")), 20, "per_day")


def q21_top5_long_flight_cities(t: BookingTables, top: int = K.Q21_TOP_N,
                                min_mean_seconds: int = K.Q21_MIN_MEAN_SECONDS) -> DataFrame:
    """Up to ``top`` departure cities whose mean arrived-flight duration is
    strictly above ``min_mean_seconds``, longest first, ties by city name.
    The limit is the feature (a top-k report): planned as TakeOrderedAndProject."""
    arrived = t.flights_v.where(F.col("status") == K.STATUS_ARRIVED)
    means = arrived.groupBy("departure_city").agg(
        F.avg(span_seconds("actual_departure", "actual_arrival")).alias("mean")
    )
    best = (
        means.where(F.col("mean") > min_mean_seconds)
        .orderBy(F.col("mean").desc_nulls_last(), F.col("departure_city").asc_nulls_last())
        .limit(top)
    )
    return answer(best, 21, "departure_city")


# Canonical answer of each question id, in mart order (the variants are
# separate query keys but not part of the mart).
CANONICAL = (
    q01_max_people_per_booking,
    q02_bookings_above_avg_size,
    q03_repeat_names_in_max_bookings,
    q04_contacts_bookings_of_three,
    q05_max_flights_per_booking,
    q06_max_flights_per_ticket,
    q07_max_flights_per_passenger,
    q08_min_spend_passengers,
    q09_max_airtime_passengers,
    q10_cities_multi_airport,
    q11_fewest_direct_cities,
    q12_unconnected_city_pairs,
    q13_unreachable_from_city,
    q14_model_most_flights,
    q15_model_most_passengers,
    q16_schedule_deviation_minutes,
    q17_destinations_on_day,
    q18_top_revenue_flights,
    q19_quietest_days,
    q20_avg_departures_per_day,
    q21_top5_long_flight_cities,
)
