"""Connected components of a link table by contraction inside tasks and stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.jobs import stored


TASK_LINKS = 100_000  # links that a task handles


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node that it reaches) by the links given, without the least ones."""
    names, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    i, j = place[: len(u)], place[len(u) :]
    root = np.arange(len(names))
    while len(i):  # hook the larger root of a link to the smaller, then shorten all paths
        a, b = root[i], root[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    out = np.flatnonzero(root != np.arange(len(names)))
    return names[out], names[root[out]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        u, v = forest(table.column(0).to_numpy(), table.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b, whole numbers): root is the
    smallest id reachable, itself included. Null ids and links of an id to itself
    are ignored; repeated links and links in either direction are one.

    Links are first contracted inside tasks of about ``TASK_LINKS`` each to
    a forest, which leaves at most one link for each node and task. While
    that is more than one task's, large-star and small-star steps alternate until
    nothing changes, which takes a number of rounds that grows with the logarithm
    of the longest chain. Each round is written to the checkpoint folder. Minima
    are partial aggregates, and both sides of each join are shuffled tables, so
    a node with a third of all links is split by adaptive skew handling.
    """
    ids = F.col("a").cast("long"), F.col("b").cast("long")
    pairs = links.where("a != b").select(F.greatest(*ids).alias("u"), F.least(*ids).alias("v"))
    now = stored(pairs.distinct())
    tasks = 1 + now.count() // TASK_LINKS

    def stored_in(df: DataFrame) -> DataFrame:
        return stored(df.coalesce(tasks))

    def contracted(df: DataFrame) -> DataFrame:
        return stored(df.coalesce(tasks).mapInArrow(_contracted, "u long, v long"))

    now = contracted(now)
    mark = None
    while tasks > 1:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored_in(both.groupBy("u").agg(F.min("v").alias("m"))
                           .select("u", F.least("u", "m").alias("m")))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored_in(large)
        least = stored_in(large.groupBy("u").agg(F.min("v").alias("m")))
        now = stored_in(
            large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        before, mark = mark, _fingerprint(now)
        if mark == before:
            break
        tasks = 1 + mark[0] // TASK_LINKS
        if tasks == 1:
            now = contracted(now)
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _fingerprint(pairs: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum((h % 1000003))).first())
