"""Query keys: ``name -> (spark, sf_dir) -> DataFrame``.

Every key reads the driver's star-schema tables through the binding, over
whole tables, and lists their files anew at each call. The extract-load keys,
the append key and the mart key write a table of their own at each call (name
and folder end in a random part), so no call touches what an earlier one
returned, and return the stored copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans import extract_load as el
from tarmac.plans import questions as q
from tarmac.plans import reports
from tarmac.plans.mart import append_answer, build_results, run_mart
from tarmac.session import storage_root
from tarmac.sources.binding import from_star_schema
from tarmac.sources.tables import BookingTables

# City/day parameters of q13, q17 and q20 for the bound data, where cities
# are nation names (the source questions name Moscow and St Petersburg).
BOUND_PARAMS = {
    "q13_unreachable_from_city": {"origin": "NATION_0"},
    "q17_destinations_on_day": {"origin": "NATION_2", "on": "2016-09-13"},
    "q20_avg_departures_per_day": {"origin": "NATION_0"},
}

QUESTION_KEYS = (
    "q01_max_people_per_booking",
    "q02_bookings_above_avg_size",
    "q03_repeat_names_in_max_bookings",
    "q04_contacts_bookings_of_three",
    "q05_max_flights_per_booking",
    "q05_max_legs_no_flight_check",
    "q06_max_flights_per_ticket",
    "q07_max_flights_per_passenger",
    "q08_min_spend_passengers",
    "q09_max_airtime_passengers",
    "q10_cities_multi_airport",
    "q11_fewest_direct_cities",
    "q11_fewest_direct_cities_by_arrival",
    "q11_fewest_departures",
    "q12_unconnected_city_pairs",
    "q13_unreachable_from_city",
    "q14_model_most_flights",
    "q15_model_most_passengers",
    "q16_schedule_deviation_minutes",
    "q17_destinations_on_day",
    "q18_top_revenue_flights",
    "q19_quietest_days",
    "q19_quietest_days_shifted",
    "q20_avg_departures_per_day",
    "q21_top5_long_flight_cities",
)


REPORT_KEYS = (
    "rank_top_passengers",
    "theta_city_pairs",
    "band_connecting_flights",
    "except_arrival_days",
)


def bound_tables(spark: SparkSession, sf_dir: str) -> BookingTables:
    return from_star_schema(spark, sf_dir)


def _question(name: str, module=q) -> Callable[[SparkSession, str], DataFrame]:
    """The query key ``name``: its question over the bound driver tables."""
    fn = getattr(module, name)
    params = BOUND_PARAMS.get(name, {})

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bound_tables(spark, sf_dir), **params)

    run.__name__ = run.__qualname__ = name
    run.__doc__ = fn.__doc__
    return run


def _target(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name and folder of this call alone."""
    table = f"tarmac_{name}_{uuid.uuid4().hex[:12]}"
    return table, f"{storage_root(spark)}/tarmac_tables/{table}"


def bound_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical answers over the bound data (binding parameters applied)."""
    return build_results(bound_tables(spark, sf_dir), BOUND_PARAMS)


def mart_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_mart(spark, bound_tables(spark, sf_dir), *_target(spark, "results"), BOUND_PARAMS)


def append_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single answers appended one after another to a results table; the second
    run of a question adds its rows again."""
    t = bound_tables(spark, sf_dir)
    table, path = _target(spark, "appended")
    for question in (q.q01_max_people_per_booking, q.q10_cities_multi_airport, q.q01_max_people_per_booking):
        out = append_answer(spark, question, t, table, path)
    return out


def el_copy_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return el.copy_table(spark, bound_tables(spark, sf_dir).seats, *_target(spark, "seats"))


def el_copy_flights_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return el.copy_by_day(spark, bound_tables(spark, sf_dir).flights_v, "actual_departure", *_target(spark, "flights_v"))


def el_sync_flights_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of an older state (some days not there yet, some with other rows,
    some gone since), brought up to date."""
    flights = bound_tables(spark, sf_dir).flights_v
    _, path = _target(spark, "flights_v_synced")
    left = F.col("actual_departure")
    week = F.coalesce(F.weekofyear(left), F.lit(0))
    older = flights.where(week != 36).withColumn("status", F.when(week == 33, F.lit("Scheduled")).otherwise(F.col("status"))).withColumn(
        "actual_departure", F.when(week == 34, F.timestamp_add("DAY", F.lit(400), left)).otherwise(left))
    el.sync_by_day(spark, older, "actual_departure", path)
    return el.sync_by_day(spark, flights, "actual_departure", path)


def bucketed_airtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q09 on copies of the tickets and their legs bucketed by ticket_no."""
    table, path = _target(spark, "bucketed")
    return q.q09_max_airtime_passengers(el.bucketed_tables(spark, bound_tables(spark, sf_dir), f"{table}_", path))


def interval_long_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q21 on a flights view that gives an interval column, stored as such."""
    t = bound_tables(spark, sf_dir)
    copy = el.copy_table(spark, reports.with_duration(t.flights_v), *_target(spark, "durations"))
    return reports.interval_long_flight_cities(t.replace(flights_v=copy))


def sql_airtime_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sql_airtime_passengers(spark, bound_tables(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        name: _question(name) for name in QUESTION_KEYS
    }
    out |= {name: _question(name, reports) for name in REPORT_KEYS}
    out["el_copy_seats"] = el_copy_seats
    out["el_copy_flights_by_day"] = el_copy_flights_by_day
    out["el_sync_flights_by_day"] = el_sync_flights_by_day
    out["bucketed_airtime"] = bucketed_airtime
    out["interval_long_flights"] = interval_long_flights
    out["sql_airtime_passengers"] = sql_airtime_passengers
    out["append_answers"] = append_answers
    out["mart_results"] = mart_results
    return out


__all__ = ["BOUND_PARAMS", "QUESTION_KEYS", "bound_mart", "queries"]
