"""Hot keys: one booking/passenger with a third of all tickets, one flight
with a third of all legs. Joins are forced to sort-merge with tiny skew
thresholds, so AQE's skew handling runs; answers must equal the oracle SQL
(run by DuckDB on the very same rows)."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tarmac.plans import questions as q
from tarmac.plans.oracle import BODIES
from tarmac.plans.registry import BOUND_PARAMS
from tarmac.sources.binding import from_star_schema
from tests.conftest import SF01
from tests.oracle_compare import _canon

KEYS = [
    "q01_max_people_per_booking", "q02_bookings_above_avg_size", "q03_repeat_names_in_max_bookings",
    "q04_contacts_bookings_of_three", "q05_max_flights_per_booking", "q06_max_flights_per_ticket",
    "q07_max_flights_per_passenger", "q08_min_spend_passengers", "q09_max_airtime_passengers",
    "q15_model_most_passengers", "q18_top_revenue_flights",
]

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    base = from_star_schema(spark, SF01)
    hot_ticket = F.col("ticket_no") % 3 == 0
    tickets = base.tickets.select(
        F.when(hot_ticket, F.lit("HOT")).otherwise(F.col("book_ref")).alias("book_ref"),
        "ticket_no",
        F.when(hot_ticket, F.lit("HOT-P")).otherwise(F.col("passenger_id")).alias("passenger_id"),
        F.when(hot_ticket, F.lit("Hot Name")).otherwise(F.col("passenger_name")).alias("passenger_name"),
        F.when(hot_ticket, F.lit("hot")).otherwise(F.col("contact_data")).alias("contact_data"),
    )
    legs = base.ticket_flights.select(
        "ticket_no",
        F.when(F.col("ticket_no") % 3 == 1, F.lit(706)).otherwise(F.col("flight_id")).alias("flight_id"),
        "amount",
    )
    # AQE splits a skewed partition by ranges of map tasks; the small test
    # files are single tasks, so the skewed inputs are stored as several files.
    root = tmp_path_factory.mktemp("skewed")
    tickets.repartition(6).write.parquet(str(root / "tickets"))
    legs.repartition(6).write.parquet(str(root / "legs"))
    t = base.replace(tickets=spark.read.parquet(str(root / "tickets")),
                     ticket_flights=spark.read.parquet(str(root / "legs")))
    con = duckdb.connect()
    for name in ("tickets", "ticket_flights", "flights_v", "flights", "aircrafts"):
        pdf = getattr(t, name).toPandas()  # small test data only
        con.register(f"{name}_pdf", pdf)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_pdf")
    yield t, con
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_hot_keys_match_oracle(spark, skewed, key):
    t, con = skewed
    df = getattr(q, key)(t, **BOUND_PARAMS.get(key, {}))
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(BODIES[key])
    assert _canon(df.columns, rows) == _canon(rel.columns, rel.fetchall())


def test_skew_join_split_is_used(spark, skewed):
    t, _ = skewed
    df = q.q07_max_flights_per_passenger(t)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "isSkewJoin=true" in plan or "skewed" in plan


def test_q04_splits_hot_bookings(spark, skewed, tmp_path):
    """One booking holds a third of all tickets, another just under 0.1 %; the
    hot shuffle partition is split, so no task of the join holds a whole large
    booking, and there is no size at which the plan changes."""
    _, _ = skewed  # its settings
    base = from_star_schema(spark, SF01)
    no = F.col("ticket_no")
    tickets = base.tickets.withColumn("book_ref", F.when(no % 3 == 0, F.lit("HOT")).when(no < 45, F.lit("WARM")).otherwise(F.col("book_ref")))
    tickets.repartition(6).write.parquet(str(tmp_path / "t"))
    t = base.replace(tickets=spark.read.parquet(str(tmp_path / "t")))
    df = q.q04_contacts_bookings_of_three(t)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Broadcast" not in plan
    join = next(s for s in plan.splitlines() if "LeftSemi" in s)
    assert "skew=true" in join
    con = duckdb.connect()
    con.register("tickets", t.tickets.toPandas())
    rel = con.sql(BODIES["q04_contacts_bookings_of_three"])
    assert _canon(df.columns, rows) == _canon(rel.columns, rel.fetchall())


def test_copies_of_one_ticket(spark, tmp_path):
    """A third of all ticket rows are copies of one ticket: both sides of the
    ticket join are plain shuffles (so AQE may split that ticket), answers equal
    the flat SQL."""
    base = from_star_schema(spark, SF01)
    n = base.tickets.count()
    one = base.tickets.where("ticket_no = 1")
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_k")).drop("_k")
    tickets = base.tickets.unionByName(copies)
    tickets.repartition(6).write.parquet(str(tmp_path / "t"))
    t = base.replace(tickets=spark.read.parquet(str(tmp_path / "t")))
    con = duckdb.connect()
    for name in ("tickets", "ticket_flights", "flights_v", "flights", "aircrafts"):
        con.register(f"{name}_pdf", getattr(t, name).toPandas())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_pdf")
    for key in ("q05_max_flights_per_booking", "q06_max_flights_per_ticket", "q07_max_flights_per_passenger",
                "q08_min_spend_passengers", "q09_max_airtime_passengers", "q01_max_people_per_booking",
                "q03_repeat_names_in_max_bookings", "q04_contacts_bookings_of_three"):
        df = getattr(q, key)(t)
        rel = con.sql(BODIES[key])
        assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall()), key
    old = {c: spark.conf.get(c, None) for c in SKEW_CONF}
    for c, v in SKEW_CONF.items():
        spark.conf.set(c, v)
    try:
        plan = q.ticket_rows(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert len(re.findall(r"Sort \[ticket_no[^\n]*\n[^\n]*Exchange hashpartitioning\(ticket_no#\d+L?, \d+\), ENSURE", plan)) == 2


def test_copies_of_one_flight(spark, tmp_path):
    """A third of all flight rows are copies of one flight, which is not the one
    with the most revenue: q14/q15/q18 and the leg questions still equal the
    flat SQL (copies multiply amounts and legs there)."""
    base = from_star_schema(spark, SF01)
    n = base.flights_v.count()
    one = base.flights_v.where("status = 'Arrived' and flight_id <> 706").orderBy("flight_id").limit(1)
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_k")).drop("_k")
    fv = base.flights_v.unionByName(copies)
    fv.repartition(6).write.parquet(str(tmp_path / "fv"))
    stored = spark.read.parquet(str(tmp_path / "fv"))
    t = base.replace(flights_v=stored, flights=stored.select("flight_id", "status"))
    con = duckdb.connect()
    for name in ("tickets", "ticket_flights", "flights_v", "flights", "aircrafts"):
        con.register(f"{name}_pdf", getattr(t, name).toPandas())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_pdf")
    for key in ("q14_model_most_flights", "q15_model_most_passengers", "q18_top_revenue_flights",
                "q05_max_flights_per_booking", "q08_min_spend_passengers", "q09_max_airtime_passengers"):
        df = getattr(q, key)(t)
        rel = con.sql(BODIES[key])
        assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall()), key
