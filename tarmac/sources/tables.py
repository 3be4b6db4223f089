"""The bookings table contract and providers that fill it.

Every question takes one :class:`BookingTables` value. Providers only build
lazy DataFrames (scans); no provider triggers a Spark action.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DayTimeIntervalType

from tarmac.functions import duration_seconds

# Columns each question may read. Providers must supply at least these;
# extra columns are ignored (Catalyst prunes them at the scan).
CONTRACT: dict[str, tuple[str, ...]] = {
    "tickets": ("book_ref", "ticket_no", "passenger_id", "passenger_name", "contact_data"),
    "ticket_flights": ("ticket_no", "flight_id", "amount"),
    "flights": ("flight_id", "status"),
    "flights_v": (
        "flight_id",
        "departure_city",
        "arrival_city",
        "aircraft_code",
        "status",
        "scheduled_departure",
        "scheduled_arrival",
        "actual_departure",
        "actual_arrival",
    ),
    "airports": ("city",),
    "aircrafts": ("aircraft_code", "model"),
    "routes": ("departure_city", "arrival_city"),
    "seats": (),
}

TABLES = tuple(CONTRACT)
OPTIONAL = ("seats",)

# Name of the day column added by the day-partitioned copy of flights_v.
DAY_PARTITION_COLUMN = "actual_departure_date"


@dataclass(frozen=True)
class BookingTables:
    """Bookings-shaped inputs. Keys assumed by the questions: ``flight_id``
    identifies one row of ``flights``/``flights_v``; ``ticket_no`` may repeat
    in ``tickets`` without changing any answer."""

    tickets: DataFrame
    ticket_flights: DataFrame
    flights: DataFrame
    flights_v: DataFrame
    airports: DataFrame
    aircrafts: DataFrame
    routes: DataFrame
    # no question reads seats; a source may lack the table
    seats: DataFrame | None = None
    # Derived tables already stored (e.g. the shared fact aggregates a
    # multi-question job writes once); questions use them when present.
    derived: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    def validate(self) -> "BookingTables":
        """Fail fast (analysis only, no job) if a contract column is missing."""
        for name in TABLES:
            if name in OPTIONAL and getattr(self, name) is None:
                continue
            have = set(getattr(self, name).columns)
            missing = [c for c in CONTRACT[name] if c not in have]
            if missing:
                raise ValueError(f"table {name} lacks columns {missing}")
        return self

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every table as a temporary view named ``prefix + name``, so
        SQL written against the bookings tables runs through ``spark.sql``.
        Returns the view names."""
        names = []
        for name in TABLES:
            if getattr(self, name) is not None:
                getattr(self, name).createOrReplaceTempView(prefix + name)
                names.append(prefix + name)
        return names

    def register_functions(self, spark: SparkSession) -> list[str]:
        """PostgreSQL's span functions for SQL over the views (see
        :func:`tarmac.functions.sql.register`). Returns their names."""
        from tarmac.functions.sql import register

        return register(spark)

    def replace(self, **frames) -> "BookingTables":
        """A copy with some tables replaced. Stored derived tables are dropped
        (they may no longer match) unless ``derived`` is given explicitly."""
        values = {f.name: getattr(self, f.name) for f in fields(self)}
        values["derived"] = {}
        values.update(frames)
        return BookingTables(**values)


def with_actual_arrival(flights_v: DataFrame) -> DataFrame:
    """A view that gives ``actual_duration`` (an interval, or ``hh:mm:ss`` text)
    instead of ``actual_arrival`` gets the arrival, counted from the departure."""
    if "actual_arrival" in flights_v.columns or not {"actual_duration", "actual_departure"} <= set(flights_v.columns):
        return flights_v
    if isinstance(flights_v.schema["actual_duration"].dataType, DayTimeIntervalType):
        return flights_v.withColumn("actual_arrival", F.col("actual_departure") + F.col("actual_duration"))
    return flights_v.withColumn(
        "actual_arrival", F.timestamp_add("SECOND", duration_seconds("actual_duration"), F.col("actual_departure")))


def _provide(load) -> BookingTables:
    frames = {name: load(name) for name in TABLES}
    frames["flights_v"] = with_actual_arrival(frames["flights_v"])
    return BookingTables(**frames).validate()


def from_catalog(spark: SparkSession, database: str | None = None,
                 names: dict[str, str] | None = None, prefix: str = "") -> BookingTables:
    """Tables read by name from the session catalog (``spark.table``).

    Catalog names are ``prefix + name`` (e.g. ``bookings_tickets``), unless
    ``names`` maps a contract name to another table name. ``seats`` may be
    missing.
    """
    names = names or {}

    def load(name: str) -> DataFrame | None:
        table = names.get(name, prefix + name)
        qualified = f"{database}.{table}" if database else table
        if name in OPTIONAL and not spark.catalog.tableExists(qualified):
            return None
        return spark.table(qualified)

    return _provide(load)


def from_parquet(spark: SparkSession, root: str) -> BookingTables:
    """Tables stored as ``<root>/<name>`` parquet directories or files;
    ``seats`` may be missing."""
    def load(name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{root}/{name}")
        except AnalysisException as e:
            if name in OPTIONAL and e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    return _provide(load)
