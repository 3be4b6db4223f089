"""Relational building blocks shared by the questions.

Scale rules followed throughout:

* Every aggregation has a map-side partial step (Spark's HashAggregate
  partial/final), so a hot key is collapsed before the shuffle.
* Aggregates over ``ticket_flights`` (the fact table) are computed per flight,
  or per ticket after one join with the flight attributes, before any other
  join, so later joins are dimension-sized, not fact-sized.
* "Rows equal to the extreme value" is a semi join against a one-row global
  aggregate: no global single-partition window, no collect to the driver.
* No cross join: missing pairs are enumerated output-sensitively.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir


def answer(df: DataFrame, qid: int, response: Column | str) -> DataFrame:
    """Shape a result as rows of the results mart: ``(id INT, response STRING)``."""
    value = F.col(response) if isinstance(response, str) else response
    return df.select(F.lit(qid).cast("int").alias("id"), value.cast("string").alias("response"))


def extreme_rows(df: DataFrame, column: str, largest: bool = True) -> DataFrame:
    """Rows whose ``column`` equals its maximum (or minimum) over ``df``.

    Ties are all kept; NULL never wins (NULL = x is not true), and an input
    with only NULLs yields no row. The extreme is a global partial/final
    aggregate — exactly one row, so broadcasting it is bounded — and the
    rows are kept by a semi join on equality: rows never leave their
    partitions, and because both sides share one plan, the grouped input is
    shuffled once and read twice (exchange reuse) instead of recomputed.
    """
    extreme = (F.max(column) if largest else F.min(column)).alias(column)
    return df.join(F.broadcast(df.agg(extreme)), column, "left_semi")


def top_value(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row with the largest ``column``; no row if ``df`` is empty
    (the ``ORDER BY column DESC LIMIT 1`` result of a grouped query)."""
    return df.agg(F.max(column).alias(name)).where(F.col(name).isNotNull())


def keys_with_size(df: DataFrame, key: str, predicate) -> DataFrame:
    """Distinct ``key`` values whose row count satisfies ``predicate(count)``."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.where(predicate(F.col("_size"))).select(key)


def splittable(df: DataFrame, key: str, /, **aggregates: Column) -> DataFrame:
    """``df`` aggregated by ``key`` (distinct keys without ``aggregates``) for a
    join on ``key`` whose other side may have hot keys.

    AQE splits a skewed partition only if both sides of the join are plain
    shuffles; an aggregate by the join key would be joined in place. Grouping
    by the key and a hash of it makes Spark shuffle the (small) result once
    more for the join, so the other side's hot partitions can be split.
    """
    hashed = df.withColumn("_key_hash", F.crc32(F.col(key).cast("string").cast("binary")))
    grouped = hashed.groupBy(key, "_key_hash")
    out = grouped.agg(*[v.alias(k) for k, v in aggregates.items()]) if aggregates else grouped.agg(F.count(F.lit(1)).alias("_n"))
    return out.drop("_key_hash", "_n")


def per_ticket(legs: DataFrame, /, **aggregates: Column) -> DataFrame:
    """Aggregate the fact table per ticket before any dimension join; the result
    is shuffled once more for the ticket join (see :func:`splittable`)."""
    return splittable(legs, "ticket_no", **aggregates)


def per_flight(legs: DataFrame, /, **aggregates: Column) -> DataFrame:
    """Aggregate the fact table per flight before any dimension join."""
    return legs.groupBy("flight_id").agg(*[v.alias(k) for k, v in aggregates.items()])


COPIES = "_copies"


def with_ticket(tickets: DataFrame, ticket_values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach per-ticket aggregates (of :func:`per_ticket`) to ticket rows, an
    inner join on ticket_no: together with :func:`roll_up` an exact rewrite of
    ``SELECT keys, count/sum(..) FROM tickets JOIN legs GROUP BY keys``.

    Rows that repeat a ticket_no, equal or not, count each as in that flat join.
    Ticket rows cross one shuffle, without a sort of their own or grouping; both
    sides are plain shuffles, so AQE splits a ticket_no that many rows repeat.
    """
    cols = [c for c in dict.fromkeys(columns) if c != "ticket_no"]
    return tickets.select("ticket_no", *cols).join(ticket_values, "ticket_no")


def roll_up(rows: DataFrame, keys: Sequence[str], /, **sums: str) -> DataFrame:
    """Sum pre-aggregated columns up to ``keys`` (``name=column``), each
    weighted by ``_copies`` when the rows carry it."""
    def term(c: str) -> Column:
        return F.col(c) * F.col(COPIES) if COPIES in rows.columns else F.col(c)

    return rows.groupBy(*keys).agg(*[F.sum(term(c)).alias(name) for name, c in sums.items()])


def dense_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Number the distinct non-NULL values of ``column`` 0..n-1 in ascending
    (binary) order, without a single-partition window.

    The values are range-partitioned and sorted; each task's position is its
    row offset inside the partition. That layout is checkpointed (to the
    session's checkpoint directory) so partition ids and positions are fixed
    facts that survive recomputation; partition sizes — one row per
    partition, a bound set by the partition count — give each partition's
    starting offset.
    """
    ensure_checkpoint_dir(df.sparkSession)
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    placed = (
        values.repartitionByRange(column)
        .sortWithinPartitions(column)
        .select(
            column,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_mono"),
        )
        .checkpoint(eager=True)
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets has one row per partition of `placed`: bounded by the partition count.
    return placed.join(F.broadcast(offsets), "_part").select(
        column,
        (F.col("_off") + F.col("_mono") - F.shiftleft(F.col("_part").cast("bigint"), 33)).alias(index),
    )


def missing_pairs(nodes: DataFrame, node: str, edges: DataFrame, src: str, dst: str,
                  left: str, right: str) -> DataFrame:
    """Pairs ``(left, right)`` of distinct non-NULL ``nodes`` with
    ``left < right`` and no edge ``left -> right`` in ``edges``.

    Output-sensitive: with nodes numbered 0..n-1, the missing partners of
    node ``a`` are the gaps between consecutive members of
    ``{a} ∪ {b > a : edge a->b} ∪ {n}``; each gap is expanded with
    ``sequence``. Work is O(edges + output); no pair that exists is ever
    generated, and there is no cross join.
    """
    idx = dense_index(nodes, node, "_i")
    n = idx.agg(F.count(F.lit(1))).scalar()
    src_idx = idx.select(F.col(node).alias(src), F.col("_i").alias("_a"))
    dst_idx = idx.select(F.col(node).alias(dst), F.col("_i").alias("_b"))
    linked = (
        edges.select(src, dst).distinct()
        .join(src_idx, src)
        .join(dst_idx, dst)
        .where(F.col("_a") < F.col("_b"))
        .select("_a", "_b")
    )
    bounds = (
        idx.select(F.col("_i").alias("_a"), F.col("_i").alias("_b"))
        .unionByName(linked)
        .unionByName(idx.select(F.col("_i").alias("_a"), n.cast("bigint").alias("_b")))
    )
    # The three bound sets are disjoint ((a, a), linked (a, b) with a < b < n,
    # and (a, n)), so no de-duplication is needed. One window group per node,
    # holding at most n + 1 bounds.
    nxt = F.lead("_b").over(Window.partitionBy("_a").orderBy("_b"))
    gaps = bounds.select("_a", (F.col("_b") + 1).alias("_lo"), (nxt - 1).alias("_hi"))
    pairs = gaps.where(F.col("_lo") <= F.col("_hi")).select(
        "_a", F.explode(F.sequence("_lo", "_hi")).alias("_b")
    )
    names_a = idx.select(F.col("_i").alias("_a"), F.col(node).alias(left))
    names_b = idx.select(F.col("_i").alias("_b"), F.col(node).alias(right))
    return pairs.join(names_a, "_a").join(names_b, "_b").select(left, right)


def unreached_from(nodes: DataFrame, node: str, edges: DataFrame, src: str, dst: str,
                   origin: str, name: str) -> DataFrame:
    """Distinct non-NULL nodes other than ``origin`` with no edge
    ``origin -> node``; empty when ``origin`` is not itself a node.
    A filtered anti join: linear, no pairs."""
    # one aggregate over the nodes serves the candidates and the question whether
    # the origin is among them (its shuffle is read twice, its scan once)
    cities = nodes.where(F.col(node).isNotNull()).groupBy(F.col(node).alias(name)).agg(F.count(F.lit(1)).alias("_rows"))
    known = cities.agg(F.bool_or((F.col(name) == F.lit(origin)) & (F.col("_rows") > 0)).alias("known")).scalar()
    # the origin is taken out by the anti join: a filter on it would make two aggregates of the one
    itself = nodes.sparkSession.range(1).select(F.lit(origin).alias(name))
    reached = edges.where(F.col(src) == F.lit(origin)).select(F.col(dst).alias(name)).unionByName(itself).distinct()
    return cities.join(reached, name, "left_anti").where((F.col("_rows") > 0) & known).select(name)


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """SQL ``left EXCEPT right``: the distinct rows of ``left`` that ``right``
    does not have, columns by position, NULL equal to NULL.

    Both sides are tagged, united and aggregated once: equal rows collapse before
    the one shuffle, however many there are."""
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} columns against {len(right.columns)}")
    names = [f"_c{i}" for i in range(len(left.columns))]
    both = left.toDF(*names).withColumn("_right", F.lit(False)).unionByName(right.toDF(*names).withColumn("_right", F.lit(True)))
    kept = both.groupBy(*names).agg(F.bool_or("_right").alias("_right")).where("not _right")
    return kept.select(*names).toDF(*left.columns)
