"""Physical-plan checks: the shapes the scale argument relies on."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tarmac.plans import questions as q
from tarmac.plans import registry
from tarmac.plans.extract_load import copy_by_day
from tarmac.session import storage_root
from tarmac.sources.binding import from_star_schema
from tests.conftest import SF01


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", registry.QUESTION_KEYS)
def test_no_cross_join_nor_global_window(spark, key):
    plan = _executed(entry.queries()[key](spark, SF01))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # Extremes are aggregate + semi join; the only windows allowed are the
    # per-node gap window of q12 and the per-partition offsets of its index.
    if key != "q12_unconnected_city_pairs":
        assert "Window" not in plan


def test_scan_prunes_columns(spark):
    plan = _executed(entry.queries()["q17_destinations_on_day"](spark, SF01))
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan


def test_fact_table_aggregated_before_dimension_join(spark):
    plan = _executed(entry.queries()["q15_model_most_passengers"](spark, SF01))
    lines = plan.splitlines()
    # The partial count per flight sits directly on the lineitem scan: no
    # join between the fact scan and its first aggregate.
    scan = next(i for i, s in enumerate(lines) if "lineitem.parquet" in s)
    agg = max(i for i, s in enumerate(lines[:scan]) if "partial_count(1)" in s)
    assert "keys=[flight_id" in lines[agg]
    assert not any("Join" in s for s in lines[agg:scan])
    # ... and the flight-sized result is what meets the flights dimension.
    assert any("keys=[aircraft_code" in s for s in lines[:agg])


def test_partitioned_copy_prunes_days(spark):
    t = from_star_schema(spark, SF01)
    path = f"{storage_root(spark)}/tarmac_tables/test_flights_by_day"
    copy = copy_by_day(spark, t.flights_v, "actual_departure", "test_flights_by_day", path)
    bound = t.replace(flights_v=copy)
    df = q.q17_destinations_on_day(bound, origin="NATION_2", on="2016-09-13")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # show full filter lists
    try:
        plan = _executed(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(actual_departure_date" in plan
    assert "2016-09-13" in plan.split("PartitionFilters:")[1].split("]")[0]
    # on stored columns the row filters reach the parquet reader too
    pushed = plan.split("PushedFilters:")[1].split(", ReadSchema")[0]
    assert "EqualTo(departure_city,NATION_2)" in pushed
    assert "In(status, [Arrived,Departed])" in pushed
    assert "GreaterThanOrEqual(actual_departure,2016-09-13" in pushed  # the day became a range
    direct = q.q17_destinations_on_day(t, origin="NATION_2", on="2016-09-13")
    assert sorted(df.collect()) == sorted(direct.collect())
    q20 = q.q20_avg_departures_per_day(bound, origin="NATION_0")
    assert q20.collect() == q.q20_avg_departures_per_day(t, origin="NATION_0").collect()


def test_staged_mart_reads_fact_table_only_through_stored_facts(spark, tmp_path):
    from tarmac.plans.mart import build_results, stage_facts
    from tarmac.plans.registry import BOUND_PARAMS

    t = from_star_schema(spark, SF01)
    staged = stage_facts(spark, t, str(tmp_path / "stage"))
    df = build_results(staged, BOUND_PARAMS)
    plan = _executed(df)
    assert "lineitem.parquet" not in plan  # every fact read comes from the stored aggregates
    assert sorted(df.collect()) == sorted(build_results(t, BOUND_PARAMS).collect())


def test_ticket_rows_are_shuffled_once_for_the_ticket_join(spark):
    """With broadcasts off: one exchange of ticket rows, by ticket_no, serves the
    collapse of copies and the join."""
    from tests.conftest import make_tables

    t = make_tables(spark)
    old = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for c in old:
        spark.conf.set(c, "-1")
    try:
        plan = q.ticket_rows(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert "Join" in plan
    above = plan.splitlines()
    scan = next(i for i, s in enumerate(above) if "passenger_id" in s and ("Scan" in s or "LocalTableScan" in s))
    join = max(i for i, s in enumerate(above[:scan]) if "Join" in s)
    exchanges = [s for s in above[join:scan] if "Exchange" in s]
    assert len(exchanges) == 1 and "hashpartitioning(ticket_no" in exchanges[0]
