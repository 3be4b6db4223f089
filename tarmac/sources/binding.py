"""Binding from the driver's star schema (orders, customer, lineitem, part,
supplier, nation) to the bookings shape.

The definitions are deterministic column rules, written once here in Spark
and once in SQL (``tarmac.plans.oracle``), so both engines answer the same
questions over the same derived tables. Everything is lazy: the views are
plain DataFrame plans over the parquet scans, so filters and column pruning
reach the files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.constants import STATUS_ARRIVED, STATUS_CANCELLED, STATUS_DEPARTED
from tarmac.sources.tables import BookingTables

# The columns of the star-schema tables (FIXTURES.md B). Given to
# the reader, so that no call runs a job to read them from file footers.
STAR_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}
STAR_TABLES = tuple(STAR_SCHEMAS)

# Binding rules (fixed values of the binding, mirrored in the oracle SQL).
EPOCH = "2016-08-01 00:00:00"  # first scheduled departure
DEPARTURE_HOUR_STEP = 37       # scheduled departure = EPOCH + (partkey * 37) % 1440 hours
DEPARTURE_HOUR_SPAN = 1440
NATIONS = 25                   # cities are nations; nation keys are 0..24


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cust_code(custkey: Column) -> Column:
    """``'%06d'``: zero-padded to six digits, never truncated (``lpad`` alone
    would cut longer keys). ``lpad`` does the common case; the per-row
    ``String.format`` behind ``format_string`` is kept for negative keys."""
    text = custkey.cast("string")
    return (
        F.when(custkey < 0, F.format_string("%06d", custkey))
        .when(F.length(text) >= 6, text)
        .otherwise(F.lpad(text, 6, "0"))
    )


def bind_tickets(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o, c = orders.alias("o"), customer.alias("c")
    code = _cust_code(F.col("o.o_custkey"))
    priority = F.substring(F.col("o.o_orderpriority"), 1, 1)
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).select(
        F.concat(code, F.lit("-"), F.year("o.o_orderdate").cast("string")).alias("book_ref"),
        F.col("o.o_orderkey").alias("ticket_no"),
        F.concat(code, F.lit("-"), priority).alias("passenger_id"),
        F.concat(F.col("c.c_name"), F.lit(" "), priority).alias("passenger_name"),
        F.concat(F.lit('{"segment": "'), F.col("c.c_mktsegment"), F.lit('"}')).alias("contact_data"),
    )


def bind_ticket_flights(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("ticket_no"),
        F.col("l_partkey").alias("flight_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    )


def nation_names(nation: DataFrame):
    """Scalar subquery: map nation key -> name over keys 0..NATIONS-1, the
    only keys the binding looks up. Rows are grouped per key first, so at
    most NATIONS rows are ever collected; a duplicated key raises (a join
    would have multiplied rows) instead of silently picking one name."""
    in_range = nation.where((F.col("n_nationkey") >= 0) & (F.col("n_nationkey") < NATIONS))
    per_key = in_range.groupBy("n_nationkey").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("n_name").alias("_name")
    )
    checked = per_key.select(
        "n_nationkey",
        F.when(F.col("_rows") == 1, F.col("_name"))
        .otherwise(F.raise_error(F.lit("nation key is not unique")))
        .alias("n_name"),
    )
    entries = F.collect_list(F.struct("n_nationkey", "n_name"))
    return checked.agg(F.map_from_entries(entries)).scalar()


def _status(size: Column) -> Column:
    return (
        F.when(size % 10 == 0, F.lit(STATUS_CANCELLED))
        .when(size % 10 == 1, F.lit("Scheduled"))
        .when(size % 10 == 2, F.lit(STATUS_DEPARTED))
        .otherwise(F.lit(STATUS_ARRIVED))
    )


def bind_flights(part: DataFrame) -> DataFrame:
    """Every part is a flight; ``flights_v`` lists those between two cities, so
    ``flights`` holds more than the view."""
    return part.select(F.col("p_partkey").alias("flight_id"), _status(F.col("p_size")).alias("status"))


def bind_flights_v(part: DataFrame, nation: DataFrame) -> DataFrame:
    """Flights from parts; the two city lookups read a nation-name map (a
    scalar subquery) instead of joining nation twice: same rows as the inner
    joins, and the view stays a plain scan of ``part`` for the planner (a
    join's size estimate is the product of its inputs, which would make
    this small view look huge)."""
    names = nation_names(nation)
    key, size = F.col("p_partkey"), F.col("p_size")
    d_key = (key % NATIONS).cast("int")
    a_key = ((key * 3 + size) % NATIONS).cast("int")
    status = _status(size)
    sched_dep = F.timestamp_add(
        "HOUR", (key * DEPARTURE_HOUR_STEP) % DEPARTURE_HOUR_SPAN, F.lit(EPOCH).cast("timestamp_ntz")
    )
    staged = part.select(
        key.alias("flight_id"),
        F.element_at(names, d_key).alias("departure_city"),
        F.element_at(names, a_key).alias("arrival_city"),
        F.col("p_brand").alias("aircraft_code"),
        status.alias("status"),
        sched_dep.alias("scheduled_departure"),
        F.timestamp_add("MINUTE", 60 + 7 * size, sched_dep).alias("scheduled_arrival"),
        F.when(
            status.isin(STATUS_ARRIVED, STATUS_DEPARTED),
            F.timestamp_add("MINUTE", key % 13, sched_dep),
        ).alias("actual_departure"),
        (60 + 7 * size + key % 7 - 2).alias("_minutes"),
        (d_key != a_key).alias("_distinct"),
    )
    # inner-join semantics: both keys must name a nation, and they must differ
    kept = staged.where(
        F.col("departure_city").isNotNull() & F.col("arrival_city").isNotNull() & F.col("_distinct")
    )
    return kept.select(
        "flight_id", "departure_city", "arrival_city", "aircraft_code", "status",
        "scheduled_departure", "scheduled_arrival", "actual_departure",
        F.when(
            F.col("status") == STATUS_ARRIVED,
            F.timestamp_add("MINUTE", F.col("_minutes"), F.col("actual_departure")),
        ).alias("actual_arrival"),
    )


def bind_airports(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
        F.col("s_suppkey").alias("airport_code"), F.col("n_name").alias("city")
    )


def bind_aircrafts(part: DataFrame) -> DataFrame:
    codes = part.select(F.col("p_brand").alias("aircraft_code")).distinct()
    return codes.select(
        "aircraft_code", F.concat(F.lit("Model "), F.expr("substring(aircraft_code, 7)")).alias("model")
    )


def bind_routes(flights_v: DataFrame) -> DataFrame:
    return flights_v.select("departure_city", "arrival_city", "aircraft_code").distinct()


def bind_seats(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_brand").alias("aircraft_code"), F.col("p_size").alias("seat_no")).distinct()


class StarTables(BookingTables):
    """Bookings views over ``<sf_dir>/<table>.parquet``. A view, and the tables
    under it, are read when they are first asked for: a question lists the
    files of its own tables only, and anew for every ``StarTables``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.__dict__.update(_spark=spark, _sf_dir=sf_dir, _read={}, derived={})

    def _star(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = _read(self._spark, self._sf_dir, name)
        return self._read[name]

    @cached_property
    def tickets(self) -> DataFrame:
        return bind_tickets(self._star("orders"), self._star("customer"))

    @cached_property
    def ticket_flights(self) -> DataFrame:
        return bind_ticket_flights(self._star("lineitem"))

    @cached_property
    def flights(self) -> DataFrame:
        return bind_flights(self._star("part"))

    @cached_property
    def flights_v(self) -> DataFrame:
        return bind_flights_v(self._star("part"), self._star("nation"))

    @cached_property
    def airports(self) -> DataFrame:
        return bind_airports(self._star("supplier"), self._star("nation"))

    @cached_property
    def aircrafts(self) -> DataFrame:
        return bind_aircrafts(self._star("part"))

    @cached_property
    def routes(self) -> DataFrame:
        return bind_routes(self.flights_v)

    @cached_property
    def seats(self) -> DataFrame:
        return bind_seats(self._star("part"))


def from_star_schema(spark: SparkSession, sf_dir: str) -> BookingTables:
    """Bookings views over ``<sf_dir>/<table>.parquet`` (lazy, no action)."""
    return StarTables(spark, sf_dir)
