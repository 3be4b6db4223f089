"""Ranks, theta joins and EXCEPT against brute force, with ties, NULLs and hot values."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tarmac.operators import By, band_join, except_rows, inequality_join, ranked, top_ranked


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


ORDERS = [
    ((By("a"),), "a asc nulls last"),
    ((By("a", descending=True),), "a desc nulls last"),
    ((By("a", nulls_last=False), By("b", descending=True, nulls_last=False)), "a asc nulls first, b desc nulls first"),
    ((By("b", descending=True), By("a")), "b desc nulls last, a asc nulls last"),
]


@pytest.mark.parametrize("order,sql", ORDERS)
@pytest.mark.parametrize("values", [3, 40])
def test_ranked_is_sql_rank(spark, order, sql, values):
    rnd = random.Random(values)
    rows = [(i, rnd.choice([None, *range(values)]), rnd.choice([None, "x", "y", "é"])) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, a int, b string").repartition(6)
    con = duckdb.connect()
    con.execute("create table t (i int, a int, b varchar)")
    con.executemany("insert into t values (?, ?, ?)", rows)
    want = sorted(con.sql(f"select i, a, b, rank() over (order by {sql}) from t").fetchall(), key=str)
    got = ranked(df, *order)
    assert rows_of(got) == want
    for k in (1, 7, 250):
        assert rows_of(top_ranked(df, k, *order)) == [r for r in want if r[3] <= k]


def test_run_of_equal_keys_over_many_partitions(spark):
    """Two thirds of all rows tie: the run fills several partitions, which all give its one rank."""
    rows = [(i, 5 if i % 3 else i // 3) for i in range(3000)] + [(9000 + i, None) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, a int").repartition(8)
    got = ranked(df, By("a"))
    want = {}
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0))
    for at, (_, a) in enumerate(ordered):
        want.setdefault(a, at + 1)
    assert {(r.a, r["rank"]) for r in got.collect()} == set(want.items())
    assert got.count() == len(rows)
    parts = got.groupBy("_p").count() if "_p" in got.columns else None
    assert parts is None  # helper columns do not show
    plan = executed(got)
    assert "Window [rank(a" in plan
    at = plan.index("Window [rank(a")
    assert "SinglePartition" not in plan[at : plan.index("Join", at) if "Join" in plan[at:] else None]


def test_ranked_replaces_a_column_of_that_name_and_takes_no_rows(spark):
    df = spark.createDataFrame([(1, "old")], "a int, rank string")
    assert [r["rank"] for r in ranked(df, By("a")).collect()] == [1]
    assert ranked(df.where("false"), By("a")).count() == 0
    assert top_ranked(df, 0, By("a")).count() == 0


def _pairs(left, right, holds):
    return sorted(((*a, *b) for a in left for b in right if a[1] is not None and b[1] is not None and holds(a[1], b[1])), key=str)


@pytest.mark.parametrize("kind,make", [("int", lambda r: r.randrange(60)), ("string", lambda r: f"s{r.randrange(60):02d}é"), ("double", lambda r: r.random())])
@pytest.mark.parametrize("strict", [True, False])
def test_inequality_join(spark, kind, make, strict):
    rnd = random.Random(3)
    left, right = ([(i, make(rnd) if rnd.random() > 0.1 else None) for i in range(90)] for _ in range(2))
    a, b = spark.createDataFrame(left, f"i int, x {kind}"), spark.createDataFrame(right, f"j int, y {kind}")
    for buckets in (1, 5, 64):
        got = inequality_join(a, b, "x", "y", strict, buckets)
        assert rows_of(got) == _pairs(left, right, (lambda x, y: x < y) if strict else (lambda x, y: x <= y))
    plan = executed(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_inequality_join_never_compares_copies_of_a_hot_value(spark):
    """A value that half of both sides hold: copies of it do not even meet."""
    n = 4000
    left = spark.range(n).select(F.col("id").alias("i"), F.when(F.col("id") % 2 == 0, 50_000).otherwise(F.col("id")).alias("x"))
    right = spark.range(n).select(F.col("id").alias("j"), F.when(F.col("id") % 2 == 0, 50_000).otherwise(200_000 + F.col("id")).alias("y"))
    met = inequality_join(left, right.where("y = 50000"), "x", "y")
    assert met.count() == (n // 2) ** 2  # the odd ones only
    inner = inequality_join(left.where("x = 50000"), right.where("y = 50000"), "x", "y")
    assert inner.count() == 0
    metric = inner._jdf.queryExecution().executedPlan()
    assert "LocalTableScan <empty>" in metric.toString() or "Join" in metric.toString()


def test_inequality_join_sides(spark):
    a = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        inequality_join(a, a, "x", "x")
    with pytest.raises(ValueError):
        inequality_join(a, spark.createDataFrame([("1",)], "y string"), "x", "y")
    assert inequality_join(a, spark.createDataFrame([], "y int"), "x", "y").count() == 0
    assert inequality_join(a.where("false"), spark.createDataFrame([], "y int"), "x", "y").count() == 0


@pytest.mark.parametrize("low,high", [(0, 0), (-3, 4), (5, 20), (-2.5, -0.5)])
def test_band_join(spark, low, high):
    rnd = random.Random(8)
    left, right = ([(i, rnd.randrange(200) if rnd.random() > 0.1 else None, rnd.choice(["p", "q", None])) for i in range(150)] for _ in range(2))
    left += [(1000 + i, 77, "p") for i in range(60)]  # a hot value
    a, b = spark.createDataFrame(left, "i int, x int, k string"), spark.createDataFrame(right, "j int, y int, k string")
    got = band_join(a, b, "x", "y", low, high, on=["k"])
    want = sorted(((i, x, k, j, y) for i, x, k in left for j, y, m in right
                   if k is not None and k == m and x is not None and y is not None and low <= y - x <= high), key=str)
    assert rows_of(got) == want
    plan = executed(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    free = band_join(a.drop("k"), b.drop("k"), "x", "y", low, high)
    assert free.count() == sum(x is not None and y is not None and low <= y - x <= high for _, x, _ in left for _, y, _ in right)


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_band_join_in_blocks(spark, hot):
    """Cells of many rows, on one side or both, equal rows among them, against brute force."""
    rnd = random.Random(11)
    make = lambda n: [(i, rnd.randrange(90) if rnd.random() > 0.1 else None, rnd.choice(["p", "q", None])) for i in range(n)]
    left, right = make(80), make(80)
    left += [(500, 40, "p")] * (70 if hot != "right" else 1)
    right += [(700, 44, "p")] * (70 if hot != "left" else 1)
    a, b = spark.createDataFrame(left, "i int, x int, k string"), spark.createDataFrame(right, "j int, y int, k string")
    want = sorted(((i, x, k, j, y) for i, x, k in left for j, y, m in right
                   if k is not None and k == m and x is not None and y is not None and -2 <= y - x <= 9), key=str)
    for block in (4, 25):
        assert rows_of(band_join(a, b, "x", "y", -2, 9, on=["k"], block=block)) == want


def test_band_join_tasks_follow_the_pairs(spark):
    """Few bytes that make many pairs, half of them of one value: no task puts out a large share."""
    n = 12_000
    left = spark.range(n).select(F.col("id").alias("i"), F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 2000).alias("x"))
    right = left.toDF("j", "y")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = band_join(left, right, "x", "y", 0, 0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == (n // 2) ** 2 + 1000 * 6**2  # the odd ones: 1,000 values, six rows each
    assert max(sizes) < sum(sizes) / 3


def test_band_join_of_an_empty_band(spark):
    a = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        band_join(a, a.toDF("y"), "x", "y", 1, 0)


def test_except_rows_like_sql(spark):
    rnd = random.Random(4)
    make = lambda: [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b"]), rnd.choice([None, 1.5])) for _ in range(14)]
    for _ in range(4):
        left, right = make(), make()
        a, b = spark.createDataFrame(left, "x int, y string, z double"), spark.createDataFrame(right, "p int, q string, r double")
        got = except_rows(a, b)
        assert got.columns == ["x", "y", "z"]
        assert rows_of(got) == sorted(set(left) - set(right), key=str)
    plan = executed(got)
    assert plan.count("Exchange hashpartitioning") - plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") <= 1
    assert "Join" not in plan
    with pytest.raises(ValueError):
        except_rows(a, b.drop("r"))
