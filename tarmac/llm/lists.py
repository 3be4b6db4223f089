"""Comparing the members of posting lists, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.jobs import stored


def in_blocks(members: DataFrame, name: str, member: str, block_rows: int, about: DataFrame | None = None) -> DataFrame:
    """The members of each list (``name``) dealt so that each pair of one list
    meets in a group (name, low, high) with at most about two times
    ``block_rows`` members: those of part ``low`` and those of part ``high``
    (column ``part``). ``about`` has more columns for each member. Lists of one
    are left out. The result is sorted by group
    within its partitions, for :func:`groups`."""
    n = F.count("*")
    sizes = stored(members.groupBy(name).agg(n.alias("n"), F.ceil(n / block_rows).cast("int").alias("parts"))
                   .where("n > 1").select(name, "parts"))
    dealt = members.join(sizes, name).withColumn("part", F.pmod(F.xxhash64(member), "parts").cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    paired = paired.select(*members.columns, "part", low, high)
    if about is not None:
        paired = paired.join(about, member)
    return (paired
            .repartition(name, "low", "high").sortWithinPartitions(name, "low", "high"))


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows with equal values of the whole-number columns ``names``, in order."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        columns = [table.column(c).to_numpy() for c in names]
        new = np.zeros(table.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(new)
        for a, b in zip(np.concatenate(([0], at[:-1])) if len(at) else [], at):
            yield table.slice(a, b - a)
        rest = table.slice(at[-1]) if len(at) else table
    if rest is not None and rest.num_rows:
        yield rest


def meets_before(names: list[np.ndarray], i: np.ndarray, j: np.ndarray, here: int) -> np.ndarray:
    """Whether members i and j share a list with a name less than ``here``: by
    bits for the lists that at least two members have."""
    out = np.zeros(len(i), dtype=bool)
    if not len(i):
        return out
    member = np.repeat(np.arange(len(names)), [len(x) for x in names])
    lists_of, place, times = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
    shared = (lists_of < here) & (times > 1)
    if not shared.any():
        return out
    column = np.cumsum(shared) - 1
    keep = shared[place]
    bits = np.zeros((len(names), int(shared.sum())), dtype=bool)
    bits[member[keep], column[place[keep]]] = True
    packed = np.packbits(bits, axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        for c in range(packed.shape[1]):
            out[at : at + len(a)] |= (packed[a, c] & packed[b, c]) != 0
    return out
