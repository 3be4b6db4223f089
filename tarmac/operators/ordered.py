"""Ranks, inequality joins and band joins over whole tables: no window over all
rows in one partition, no nested-loop join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir

SAMPLE_ROWS = 4096  # values that set the bounds of an inequality join
BUCKETS = 64
BLOCK_ROWS = 2048   # rows of each side that a band join compares with each other at a time


class By(NamedTuple):
    """One column of an order."""

    column: str
    descending: bool = False
    nulls_last: bool = True

    @property
    def sort(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


class _Placed(NamedTuple):
    rows: DataFrame      # range-partitioned and sorted, with _part
    parts: DataFrame     # a row per partition: rows before it, rows before its first run


def _placed(df: DataFrame, order: Sequence[By]) -> _Placed:
    """The rows in order over partitions of about equal size. Rows of one key may
    span partitions: a number that differs for every row is the last column of
    the range. The layout is checkpointed, so that partition numbers are facts."""
    ensure_checkpoint_dir(df.sparkSession)
    keys = F.struct(*[F.col(b.column) for b in order])
    sorts = [b.sort for b in order]
    rows = (
        df.withColumn("_spread", F.monotonically_increasing_id())
        .repartitionByRange(*sorts, F.col("_spread")).sortWithinPartitions(*sorts, "_spread")
        .drop("_spread").withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    at = F.monotonically_increasing_id().alias("_at")
    ends = rows.select("_part", keys.alias("_key"), at).groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by("_key", "_at").alias("_first"), F.max_by("_key", "_at").alias("_last"))
    # as many rows as `rows` has partitions: bounded by the shuffle partitions
    tails = (rows.join(F.broadcast(ends.select("_part", "_last")), "_part").where(keys.eqNullSafe(F.col("_last")))
             .groupBy("_part").agg(F.count(F.lit(1)).alias("_tail")))
    over = Window.orderBy("_part")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ends.join(tails, "_part")
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_goes_on", F.lag("_last").over(over).eqNullSafe(F.col("_first")))
        # rows before the last run, unknown where that run is the whole partition and began earlier
        .withColumn("_own", F.when(~(F.col("_goes_on") & F.col("_first").eqNullSafe(F.col("_last"))), F.col("_before") + F.col("_n") - F.col("_tail")))
        .select("_part", "_before", F.when(F.col("_goes_on"), F.last("_own", ignorenulls=True).over(before)).otherwise(F.col("_before")).alias("_run"))
    )
    return _Placed(rows, parts)


def _with_rank(placed: _Placed, order: Sequence[By], name: str, columns: list[str]) -> DataFrame:
    within = F.rank().over(Window.partitionBy("_part").orderBy(*[b.sort for b in order]))
    rows = placed.rows.join(F.broadcast(placed.parts), "_part").withColumn("_within", within)
    rank = F.when(F.col("_within") == 1, F.col("_run") + 1).otherwise(F.col("_before") + F.col("_within"))
    return rows.select(*columns, rank.alias(name))


def ranked(df: DataFrame, *order: By, name: str = "rank") -> DataFrame:
    """``df`` with ``rank() over (order by ...)`` as column ``name``.

    Rows are range-partitioned (keys that tie may fill several partitions),
    ranked inside their partition, and shifted by the rows before it. A partition that
    begins inside a run of equal keys takes the rank that the run had where it
    began, carried over as many partitions as it spans. The only window without a
    key is over one row per partition.
    """
    columns = [c for c in df.columns if c != name]
    return _with_rank(_placed(df.select(*columns), order), order, name, columns)


def top_ranked(df: DataFrame, k: int, *order: By, name: str = "rank") -> DataFrame:
    """Rows with a rank of at most ``k``, ties kept (``rank() ... <= k``). Only
    partitions that begin at one of the first ``k`` ranks are ranked."""
    columns = [c for c in df.columns if c != name]
    placed = _placed(df.select(*columns), order)
    first = _Placed(placed.rows, placed.parts.where(F.col("_run") < k))
    return _with_rank(first, order, name, columns).where(F.col(name) <= k)


def _bounds(values: list[DataFrame], buckets: int) -> list:
    """Up to ``buckets`` - 1 quantiles of a random sample of ``SAMPLE_ROWS`` values."""
    both = values[0]
    for v in values[1:]:
        both = both.union(v)
    both = both.toDF("v").where("v is not null")
    sample = [r.v for r in both.orderBy(F.rand(7)).limit(SAMPLE_ROWS).orderBy("v").collect()]
    at = sorted({len(sample) * i // buckets for i in range(1, buckets)}) if sample else []
    out: list = []
    for i in at:
        if not out or sample[i] != out[-1]:
            out.append(sample[i])
    return out


def _bucket(x: Column, bounds: list, low: int, high: int, kind) -> Column:
    """2 i + 1 for the bound i itself, 2 i for what lies before it (and after
    bound i - 1), by a binary tree of comparisons."""
    if low == high:
        return F.lit(2 * low)
    mid = (low + high) // 2
    bound = F.lit(bounds[mid]).cast(kind)
    return (F.when(x < bound, _bucket(x, bounds, low, mid, kind)).when(x == bound, F.lit(2 * mid + 1))
            .otherwise(_bucket(x, bounds, mid + 1, high, kind)))


def _disjoint(left: DataFrame, right: DataFrame, shared: Sequence[str] = ()) -> None:
    clash = (set(left.columns) & set(right.columns)) - set(shared)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")


def inequality_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, strict: bool = True,
                    buckets: int = BUCKETS) -> DataFrame:
    """Pairs with ``left_on < right_on`` (``<=`` unless ``strict``) of any type
    that sorts; NULLs match nothing.

    Both sides are cut at common quantile bounds; every bound is a bucket of
    its own, between two open ones. A left row goes to its bucket and all later
    ones, where it meets right rows in an equi-join: later buckets match whole, and
    values are compared only in a left row's own open bucket. A value with a large
    share of the rows is a bound, so its copies are never compared with each other.
    Work follows the output: every copy of a left row meets a whole bucket.
    """
    _disjoint(left, right)
    kind = left.schema[left_on].dataType
    if kind != right.schema[right_on].dataType:
        raise ValueError(f"{left_on} and {right_on} have different types")
    bounds = _bounds([left.select(left_on), right.select(right_on)], buckets)
    last = 2 * len(bounds)
    bucket = lambda c: _bucket(F.col(c), bounds, 0, len(bounds), kind)
    first = F.col("_own") + (F.col("_own") % 2 if strict else F.lit(0))
    l_rows = (left.where(F.col(left_on).isNotNull()).withColumn("_own", bucket(left_on)).where(first <= last)
              .withColumn("_bucket", F.explode(F.sequence(first, F.lit(last)))))
    r_rows = right.where(F.col(right_on).isNotNull()).withColumn("_bucket", bucket(right_on))
    compared = F.col(left_on) < F.col(right_on) if strict else F.col(left_on) <= F.col(right_on)
    return l_rows.join(r_rows, "_bucket").where((F.col("_own") < F.col("_bucket")) | compared).select(*left.columns, *right.columns)


def _dealt(left: DataFrame, right: DataFrame, keys: Sequence[str], block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of an equi-join on ``keys`` dealt over tasks by the pairs that they
    make, and the columns to join on. A task gets about ``block`` squared pairs:
    adaptive plans count bytes, of which many pairs may come from few.

    A key with more than ``block`` rows on a side is a grid: a left row belongs to
    a line of it and is copied along that, a right row to a column, so each pair
    meets in one square. There is at most a copy for every ``block`` / 2 pairs."""
    ensure_checkpoint_dir(left.sparkSession)
    one = lambda df, l, r: df.select(*keys, F.lit(l).alias("_l"), F.lit(r).alias("_r"))
    sizes = (one(left, 1, 0).unionByName(one(right, 0, 1)).groupBy(*keys)
             .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r")).checkpoint())
    work = sizes.agg(F.sum(F.col("_l").cast("double") * F.col("_r") + F.col("_l") + F.col("_r"))).first()[0] or 0
    tasks = math.ceil(work / block**2)
    if tasks <= 1:
        return left, right, list(keys)
    cuts = lambda c: F.ceil(F.col(c) / block)
    # at most a row for every `block` rows of both sides
    grids = F.broadcast(sizes.where((F.greatest("_l", "_r") > block) & (F.least("_l", "_r") > 0))
                        .select(*keys, cuts("_l").alias("_lines"), cuts("_r").alias("_columns")))

    def placed(df: DataFrame, own: str, across: str) -> DataFrame:
        row = F.xxhash64(F.monotonically_increasing_id())
        count = lambda c: F.coalesce(F.col(f"{c}s"), F.lit(1).cast("bigint"))
        return (df.join(grids, list(keys), "left").withColumn(own, F.pmod(row, count(own)))
                .withColumn(across, F.explode(F.sequence(F.lit(0).cast("bigint"), count(across) - 1)))
                .repartition(tasks, *keys, "_line", "_column").drop("_lines", "_columns"))

    return placed(left, "_line", "_column"), placed(right, "_column", "_line"), [*keys, "_line", "_column"]


def band_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, low, high, on: Sequence[str] = (),
              block: int = BLOCK_ROWS) -> DataFrame:
    """Pairs with ``low <= right_on - left_on <= high`` (numbers) and equal
    ``on`` columns; NULLs match nothing.

    Values are cut into cells as wide as the band, so a left row's band lies in at
    most two cells: it is copied to them and meets right rows in an equi-join on
    the cell (and ``on``). Tasks are as many as the pairs in the cells ask for, and
    a cell with more than ``block`` rows of a side is compared in several.
    """
    _disjoint(left, right, on)
    if high < low:
        raise ValueError(f"the band from {low} to {high} is empty")
    width = (high - low) or 1
    cell = lambda x: F.floor(x / F.lit(width)).cast("bigint")
    at = F.col(left_on)
    known = lambda df, *names: reduce(lambda x, c: x.where(F.col(c).isNotNull()), names, df)
    l_rows = known(left, left_on, *on).withColumn("_cell", F.explode(F.sequence(cell(at + F.lit(low)), cell(at + F.lit(high)))))
    r_rows = known(right, right_on, *on).withColumn("_cell", cell(F.col(right_on)))
    l_rows, r_rows, keys = _dealt(l_rows, r_rows, ["_cell", *on], block)
    apart = F.col(right_on) - F.col(left_on)
    out = l_rows.join(r_rows, keys).where(apart.between(F.lit(low), F.lit(high)))
    return out.select(*left.columns, *[c for c in right.columns if c not in on])
