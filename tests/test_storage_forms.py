"""Bucketed copies, equi-depth JDBC splits, interval durations and SQL span functions."""

from __future__ import annotations

import bisect
import collections
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tarmac.functions import sql
from tarmac.jobs import _parse
from tarmac.plans import questions as q
from tarmac.plans import reports
from tarmac.plans.extract_load import bucketed_tables
from tarmac.sources.binding import from_star_schema
from tarmac.sources.jdbc import Cell, EquiDepthSplit, equi_depth_bounds, histogram_query
from tarmac.sources.tables import with_actual_arrival
from tests.conftest import SF001, flight, make_tables

TICKET_QUESTIONS = ("q05_max_flights_per_booking", "q05_max_legs_no_flight_check", "q06_max_flights_per_ticket",
                    "q07_max_flights_per_passenger", "q08_min_spend_passengers", "q09_max_airtime_passengers")


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    t = from_star_schema(spark, SF001)
    return t, bucketed_tables(spark, t, "bk_test_", str(tmp_path_factory.mktemp("bucketed")), 4)


@pytest.mark.parametrize("key", TICKET_QUESTIONS)
def test_bucketed_copies_join_without_an_exchange(spark, bucketed, key):
    plain, t = bucketed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the ticket join itself is a sort-merge join
    try:
        df = getattr(q, key)(t.replace(flights=t.flights, flights_v=t.flights_v))
        plan = df._jdf.queryExecution().executedPlan().toString()
        want = sorted(r.response for r in getattr(q, key)(plain).collect())
        assert sorted(r.response for r in df.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, s in enumerate(lines) if "bk_test_tickets" in s)
    join = max(i for i, s in enumerate(lines[:scan]) if "Join" in s)
    assert not [s for s in lines[join:scan] if "Exchange" in s]
    if key == "q05_max_legs_no_flight_check":  # the legs meet no flight before: no exchange on either side
        legs = next(i for i, s in enumerate(lines) if "bk_test_ticket_flights" in s)
        assert not [s for s in lines[join:legs] if "Exchange" in s]


def test_bucketed_legs_stay_in_their_buckets_beside_small_flights(spark, bucketed):
    _, t = bucketed
    small = t.replace(flights=F.broadcast(t.flights), flights_v=F.broadcast(t.flights_v))
    legs = small.ticket_flights.join(F.broadcast(small.flights), "flight_id")
    text = small.tickets.join(legs, "ticket_no")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ticket_no" not in text


def counter(keys):
    keys = sorted(keys)

    def count(low, high, cells):
        width = -(-(high - low + 1) // cells)
        found = collections.Counter((k - low) // width for k in keys[bisect.bisect_left(keys, low) : bisect.bisect_right(keys, high)])
        return [Cell(low + c * width, min(high, low + (c + 1) * width - 1), n) for c, n in found.items()]

    return count


def parts_of(keys, bounds):
    return collections.Counter(bisect.bisect_right(bounds, k) for k in keys)


@pytest.mark.parametrize("seed", range(4))
def test_equi_depth_parts_of_skewed_keys(seed):
    """A dense range, far outliers and an even rest: no part is over two times another."""
    rng = random.Random(seed)
    keys = [rng.randrange(1000, 9000) for _ in range(20_000)] + [rng.randrange(10**12) for _ in range(5000)] + [int(10 ** rng.uniform(0, 11)) for _ in range(5000)]
    for parts in (1, 4, 16):
        bounds = equi_depth_bounds(counter(keys), min(keys), max(keys), parts, cells=50)
        sizes = parts_of(keys, bounds)
        assert len(sizes) == parts and sum(sizes.values()) == len(keys)
        assert max(sizes.values()) <= 2 * min(sizes.values())
    even = [min(keys) + (max(keys) - min(keys)) * i // 16 for i in range(1, 16)]
    assert max(parts_of(keys, even).values()) > 0.7 * len(keys)  # what even strides give


def test_equi_depth_with_a_hot_key_and_few_keys():
    keys = [5] * 1000 + list(range(100, 200))
    bounds = equi_depth_bounds(counter(keys), 5, 199, 4, cells=10)
    sizes = parts_of(keys, bounds)
    assert sum(sizes.values()) == len(keys) and sizes[0] == 1000  # one key can't be cut by ranges
    assert equi_depth_bounds(counter([7]), 7, 7, 3) == ()
    assert equi_depth_bounds(counter([-3, 4]), -3, 4, 2) == (4,)
    with pytest.raises(ValueError):
        equi_depth_bounds(counter([1]), 1, 1, 0)


def test_equi_depth_predicates_are_a_partition():
    con = duckdb.connect()
    con.execute("create table t (k bigint)")
    con.execute("insert into t select * from range(-50, 50)")
    con.execute("insert into t values (null), (null)")
    for bounds in ((), (3,), (-20, 0, 30)):
        counts = [con.sql(f"select count(*) from t where {p}").fetchall()[0][0] for p in EquiDepthSplit("k", bounds).predicates()]
        assert sum(counts) == 102 and counts[-1] == 2 and len(counts) == len(bounds) + 2


def test_histogram_query_counts_every_key_once():
    con = duckdb.connect()
    con.execute("create table t as select -7 + 3 * range as k from range(100)")
    query, width = histogram_query("t", "k", -7, 290, 9)
    got = {int(c): n for c, n in con.sql(query).fetchall()}
    assert got == collections.Counter((-7 + 3 * i + 7) // width for i in range(100))


def test_equi_depth_option():
    base = ["extract-load", "--url", "u", "--target-root", "r", "--split", "flights_v=flight_id", "--partitions", "4"]
    assert _parse([*base, "--equi-depth"]).equi_depth and not _parse(base).equi_depth
    with pytest.raises(SystemExit):
        _parse([*base, "--equi-depth", "--modulo"])


LONG = [flight(1, dep="A", ad="2016-09-01 10:00:00", aa="2016-09-02 12:00:00"), flight(2, dep="A", ad="2016-09-01 10:00:00", aa="2016-09-01 10:30:00"),
        flight(3, dep="B", ad="2016-09-01 10:00:00", aa="2016-09-01 13:00:00"), flight(4, dep="C", ad="2016-09-01 10:00:00", aa="2016-09-04 10:00:01"),
        flight(5, dep="C", ad="2016-09-01 10:00:00"), flight(6, dep="D", status="Scheduled")]


def test_interval_durations_like_timestamps(spark, tmp_path):
    """Spans of 24 hours and over are whole; exactly 3 hours is not above 3 hours; unknown ones do not count."""
    t = make_tables(spark, flights_v=LONG)
    view = reports.with_duration(t.flights_v)
    assert dict(view.dtypes)["actual_duration"] == "interval day to second" and "actual_arrival" not in view.columns
    view.write.parquet(str(tmp_path / "fv"))
    stored = spark.read.parquet(str(tmp_path / "fv"))
    got = reports.interval_long_flight_cities(t.replace(flights_v=stored)).collect()
    assert [tuple(r) for r in got] == [(21, "C"), (21, "A")]
    assert sorted(got) == sorted(q.q21_top5_long_flight_cities(t).collect())
    back = with_actual_arrival(stored)
    key = lambda r: r.flight_id
    assert [r.actual_arrival for r in sorted(back.collect(), key=key)] == [r.actual_arrival for r in sorted(t.flights_v.collect(), key=key)]


def test_span_functions(spark):
    assert sql.register(spark) == list(sql.FUNCTIONS)
    row = spark.sql("""SELECT epoch(age(timestamp_ntz'2016-09-14 12:00:01.9', timestamp_ntz'2016-09-13 10:00:00')),
        to_char_span(seconds_span(363785)), to_char_span(age(timestamp_ntz'2016-09-13 10:00:07', timestamp_ntz'2016-09-13 10:00:00')),
        epoch(span('25:00:30')), span('26:00:00') > INTERVAL '25' HOUR, epoch(age(NULL, timestamp_ntz'2016-09-13 10:00:00')),
        to_char_span(NULL), epoch(age(timestamp_ntz'2016-09-13 10:00:00', timestamp_ntz'2016-09-13 10:00:10'))""").first()
    assert tuple(row) == (93601, "101:03:05", "00:00:07", 90030, True, None, None, -10)


def test_sql_over_the_views_is_q09(spark):
    t = from_star_schema(spark, SF001)
    df = reports.sql_airtime_passengers(spark, t)
    assert sorted(df.collect()) == sorted(q.q09_max_airtime_passengers(t).collect())
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
