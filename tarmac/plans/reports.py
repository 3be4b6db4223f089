"""Reports that use the general forms of the questions' operators: ranks beyond
the first, theta joins and EXCEPT over columns that hold NULLs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import constants as K
from tarmac.functions import day, span_seconds
from tarmac.operators import By, answer, band_join, except_rows, inequality_join, roll_up, top_ranked
from tarmac.plans.questions import ticket_rows
from tarmac.sources.tables import BookingTables

TOP_RANK = 100
CONNECTION_SECONDS = (30 * 60, 240 * 60)
ZERO = "1970-01-01 00:00:00"


def rank_top_passengers(t: BookingTables, k: int = TOP_RANK) -> DataFrame:
    """Passengers with a rank of at most ``k`` by flight legs, ties kept:
    (rank, passenger_id, legs). The rank limit is the feature."""
    legs = roll_up(ticket_rows(t), ["passenger_id"], legs="legs").where("legs is not null")
    return top_ranked(legs, k, By("legs", descending=True)).select("rank", "passenger_id", "legs")


def theta_city_pairs(t: BookingTables) -> DataFrame:
    """Pairs ``c1 < c2`` of the cities that have an airport."""
    cities = t.airports.select("city").distinct()
    return inequality_join(cities.toDF("c1"), cities.toDF("c2"), "c1", "c2")


def band_connecting_flights(t: BookingTables, wait: tuple[int, int] = CONNECTION_SECONDS) -> DataFrame:
    """Arrived flights with each flight that left the same city within the
    waiting time: (first_flight, second_flight, wait_seconds)."""
    at = lambda c: span_seconds(F.lit(ZERO).cast("timestamp_ntz"), c)
    first = t.flights_v.where(F.col("status") == K.STATUS_ARRIVED).select(
        F.col("flight_id").alias("first_flight"), F.col("arrival_city").alias("city"), at("actual_arrival").alias("landed"))
    second = t.flights_v.where(F.col("status").isin(K.STATUS_ARRIVED, K.STATUS_DEPARTED)).select(
        F.col("flight_id").alias("second_flight"), F.col("departure_city").alias("city"), at("actual_departure").alias("left"))
    met = band_join(first, second, "landed", "left", *wait, on=["city"])
    return met.select("first_flight", "second_flight", (F.col("left") - F.col("landed")).alias("wait_seconds"))


def except_arrival_days(t: BookingTables) -> DataFrame:
    """(arrival_city, day of arrival, NULL if it is unknown) of all flights
    except those of departed flights, whose day is unknown."""
    days = t.flights_v.select("status", "arrival_city", day("actual_arrival").alias("arrival_day"))
    return except_rows(days.drop("status"), days.where(F.col("status") == K.STATUS_DEPARTED).drop("status"))


def with_duration(flights_v: DataFrame) -> DataFrame:
    """The view with ``actual_duration`` (INTERVAL DAY TO SECOND) instead of the arrival."""
    span = (F.col("actual_arrival") - F.col("actual_departure")).cast("interval day to second")
    return flights_v.withColumn("actual_duration", span).drop("actual_arrival")


def interval_long_flight_cities(t: BookingTables, top: int = K.Q21_TOP_N, longer_than: str = "0 03:00:00") -> DataFrame:
    """q21 on the interval column itself: up to ``top`` departure cities whose
    mean ``actual_duration`` is above an interval, longest first, ties by name."""
    arrived = t.flights_v.where(F.col("status") == K.STATUS_ARRIVED)
    means = arrived.groupBy("departure_city").agg(F.avg("actual_duration").alias("mean"))
    best = (means.where(F.col("mean") > F.expr(f"INTERVAL '{longer_than}' DAY TO SECOND"))
            .orderBy(F.col("mean").desc_nulls_last(), F.col("departure_city").asc_nulls_last()).limit(top))
    return answer(best, 21, "departure_city")


AIRTIME_SQL = """
    WITH flown AS (
        SELECT t.passenger_id, t.passenger_name, t.contact_data, epoch(age(f.actual_arrival, f.actual_departure)) AS seconds
        FROM {p}tickets t JOIN {p}ticket_flights l ON l.ticket_no = t.ticket_no JOIN {p}flights_v f ON f.flight_id = l.flight_id
        WHERE f.status = 'Arrived'
    ), totals AS (
        SELECT passenger_id, passenger_name, contact_data, sum(seconds) AS seconds FROM flown GROUP BY ALL
    )
    SELECT 9 AS id, passenger_id || '|' || passenger_name || '|' || contact_data || '|' || to_char_span(seconds_span(seconds)) AS response
    FROM totals WHERE seconds = (SELECT max(seconds) FROM totals)"""


def sql_airtime_passengers(spark: SparkSession, t: BookingTables) -> DataFrame:
    """q09 as a user's SQL over the registered views and span functions."""
    prefix = f"v{uuid.uuid4().hex[:12]}_"
    t.register_functions(spark)
    views = t.register_views(prefix)
    try:
        return spark.sql(AIRTIME_SQL.format(p=prefix))
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
