"""Hard-negative mining with exact integer scores from residue number systems.

Vectors of whole numbers are multiplied modulo several small primes: in each
residue system the matrix product is float32 and exact (residues are centred,
and at most ``CHUNK`` products below 2**18 are summed before reducing), and the
signed score is put together by Chinese remaindering in mixed radix. The number
of primes follows from the largest squared norm, which bounds every score
(Cauchy-Schwarz).

Anchors are a stated query set, scored against all rows in blocks: rows and
anchors are numbered and dealt by a hash of that number to blocks of about
``ROW_BLOCK`` and ``ANCHOR_BLOCK``, whatever their label, and every pair of an
anchor block and a row block is one group of bounded size. The first pass gives
each anchor's positives, the second, with the window that each positive opens,
its negatives; a group puts out no more than it may contribute to the answer.

Cases: rows with a null label, a null vector or a null or non-finite component take no
part, nor do vectors with a squared norm of ``NORM_LIMIT`` (2**59) or more, whose
scores may not fit a long. Vectors are compared with those of their own length
only. A repeated row is a row of its own, also as an anchor and as another row
for its copy; equal scores go by id (nulls last), then by number. An empty table
gives an empty result; other columns are not read. Null ids may be positives and
negatives but are never anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm.jobs import prepared, stored
from tarmac.llm.lists import groups

# Primes below 1024.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
CHUNK = 64            # 64 * 510**2 < 2**24, the whole numbers of float32
NORM_LIMIT = 1 << 59
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LEAST_SHARE = (4, 5)  # of a positive's score that a negative's must reach
ANCHOR_BLOCK = 2048
ROW_BLOCK = 2048
TOGETHER = 128        # anchors of a block whose scores are held together


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as signed whole numbers up to ``bound`` need."""
    out, product = [], 1
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound:
            return tuple(out)
    raise ValueError(f"scores up to {bound} need more primes")


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole numbers between -(p - 1) / 2 and (p - 1) / 2."""
    return (x + p // 2) % p - p // 2


def residue_planes(x: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    return [centred(x, p).astype(np.float32) for p in primes]


def products(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact inner products (int64) of the rows behind the residues a and b."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        r = np.zeros((len(a[k]), len(b[k])), dtype=np.float32)
        for at in range(0, a[k].shape[1], CHUNK):
            r += centred(a[k][:, at : at + CHUNK] @ b[k][:, at : at + CHUNK].T, p)
            r = centred(r, p)
        # mixed radix: the digit that makes the number so far agree modulo p
        value, weight = np.zeros_like(r), 1
        for d, q in zip(digits, primes):
            value = centred(value + d * np.float32(centred(np.int64(weight), p)), p)
            weight = weight * q % p
        digits.append(centred((r - value) * np.float32(centred(np.int64(pow(weight, -1, p)), p)), p) if k else r)
    score, weight = np.zeros(digits[0].shape, dtype=np.int64), 1
    for d, q in zip(digits, primes):
        score += d.astype(np.int64) * np.int64(weight)
        weight *= q
        weight = (weight + (1 << 63)) % (1 << 64) - (1 << 63)  # sums wrap around to the score itself
    return score


def _quantized(scale: int):
    """(vec_id, label, vector, norm) of the rows that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, raw, norms = [], [], []
            label, vectors = batch.column(1), batch.column(2)
            for i in range(batch.num_rows):
                v = vectors[i]
                if not v.is_valid or not label[i].is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore"):
                    x = np.floor(scale * x)
                    norm = float((x * x).sum())
                if np.isfinite(norm) and norm < NORM_LIMIT:
                    keep.append(i)
                    raw.append(x.astype("<i4").tobytes())
                    norms.append(norm)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, type=pa.int64())), label.take(pa.array(keep, type=pa.int64())),
                 pa.array(raw, type=pa.binary()), pa.array(norms, type=pa.float64())], names=["vec_id", "label", "vector", "norm"])

    return run


def _paired(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """Both, in groups (anchor_block, row_block) with ``side`` 0 for anchors."""
    block = lambda n: F.pmod(F.xxhash64("number"), F.lit(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    rows = rows.select(every(anchor_blocks).alias("anchor_block"), block(row_blocks).alias("row_block"), F.lit(1).alias("side"), "*")
    anchors = anchors.select(block(anchor_blocks).alias("anchor_block"), every(row_blocks).alias("row_block"), F.lit(0).alias("side"), "*")
    both = anchors.unionByName(rows, allowMissingColumns=True)
    tasks = max(1, min(row_blocks * anchor_blocks, 1 << 20))
    return both.repartition(tasks, "anchor_block", "row_block").sortWithinPartitions("anchor_block", "row_block", "side", "number")


def _scored(g: pa.Table, primes: tuple[int, ...]) -> Iterator[tuple[pa.Table, pa.Table, np.ndarray]]:
    """Some anchors of a group, the rows of their length and the scores."""
    size = tx.byte_view(g.column("vector"))[1]
    g = g.append_column("size", pa.array(np.diff(size)))
    for n in np.unique(np.diff(size)).tolist():
        part = g.filter(pa.compute.equal(g.column("size"), n))
        side = part.column("side").to_numpy()
        split = int(np.searchsorted(side, 1))
        if not 0 < split < len(side):
            continue
        values = np.ascontiguousarray(tx.byte_view(part.column("vector"))[0]).view("<i4").reshape(len(side), n // 4).astype(np.int64)
        rows = part.slice(split)
        of_rows = residue_planes(values[split:], primes)
        for at in range(0, split, TOGETHER):
            stop = min(split, at + TOGETHER)
            yield part.slice(at, stop - at), rows, products(residue_planes(values[at:stop], primes), of_rows, primes)


def _firsts(i: np.ndarray, n: int) -> np.ndarray:
    """Which of the sorted names are among the first n of their name."""
    at = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1]))) if len(i) else np.zeros(0, dtype=np.int64)
    return np.arange(len(i)) - np.repeat(at, np.diff(np.append(at, len(i)))) < n


def _rank_of(rows: pa.Table) -> np.ndarray:
    """Each row's place by id (nulls last), then by number."""
    order = pa.compute.sort_indices(rows.select(["vec_id", "number"]), sort_keys=[("vec_id", "ascending"), ("number", "ascending")]).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place


def _best_positives(primes: tuple[int, ...], keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["anchor_block", "row_block"]):
            for anchors, rows, score in _scored(g, primes):
                same = _same_label(anchors, rows)
                same &= anchors.column("number").to_numpy()[:, None] != rows.column("number").to_numpy()[None, :]
                i, j = np.nonzero(same)
                s = score[i, j]
                order = np.lexsort((_rank_of(rows)[j], -s, i))
                order = order[_firsts(i[order], keep)]
                yield pa.RecordBatch.from_arrays(
                    [anchors.column("number").combine_chunks().take(pa.array(i[order])),
                     rows.column("number").combine_chunks().take(pa.array(j[order])),
                     rows.column("vec_id").combine_chunks().take(pa.array(j[order])), pa.array(s[order])],
                    names=["anchor", "number", "positive_id", "positive_score"])

    return run


def _same_label(anchors: pa.Table, rows: pa.Table) -> np.ndarray:
    """Where the labels of an anchor and a row are the same."""
    both = pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
    return both[: len(anchors), None] == both[None, len(anchors) :]


def _best_negatives(primes: tuple[int, ...], keep: int, share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["anchor_block", "row_block"]):
            for anchors, rows, score in _scored(g, primes):
                other = ~_same_label(anchors, rows)
                place = _rank_of(rows)
                number, names = (rows.column(c).combine_chunks() for c in ("number", "vec_id"))
                opened = anchors.column("positives").to_pylist()
                about = anchors.select(["number", "vec_id"]).rename_columns(["anchor", "anchor_id"]).combine_chunks()
                for nth in range(max(map(len, opened), default=0)):
                    at = [p[nth] if nth < len(p) else None for p in opened]
                    top = np.array([p["positive_score"] if p else -1 for p in at], dtype=np.int64)
                    least = -((-top * share[0]) // share[1])  # above the top where that is below zero
                    i, j = np.nonzero(other & (score <= top[:, None]) & (score >= least[:, None]))
                    s = score[i, j]
                    order = np.lexsort((place[j], -s, i))
                    order = order[_firsts(i[order], keep)]
                    if not len(order):
                        continue
                    own, them = i[order], pa.array(j[order])
                    whose = about.take(pa.array(own)).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [*(whose.column(c).combine_chunks() for c in ("anchor", "anchor_id")),
                         pa.array(np.full(len(own), nth, dtype=np.int64)), pa.array([at[a]["positive_id"] for a in own.tolist()], type=names.type),
                         pa.array(top[own]), number.take(them), names.take(them), pa.array(s[order])],
                        names=["anchor", "anchor_id", "nth", "positive_id", "positive_score", "number", "negative_id", "negative_score"])

    return run


def _first_by(df: DataFrame, keys: list[str], score: str, name: str, n: int) -> DataFrame:
    """The first n rows of each key, numbered from 1 in ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(name), "number")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, anchors: Column, id_column: str = "vec_id", label: str = "label", column: str = "embedding",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = LEAST_SHARE,
                   scale: int = SCALE, anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for each anchor (a condition on ``vec_id`` and ``label``)
    and each of its first positives: the first rows of another label with a
    score of at most the positive's and at least ``share`` of it."""
    spark = prepared(vectors)
    source = vectors.select(F.col(id_column).alias("vec_id"), F.col(label).alias("label"), F.col(column).alias("vector"))
    kind, label_kind = source.schema["vec_id"].dataType, source.schema["label"].dataType
    found = StructType([StructField("vec_id", kind), StructField("label", label_kind), StructField("vector", BinaryType()), StructField("norm", DoubleType())])
    rows = stored(source.mapInArrow(_quantized(scale), found)).withColumn("number", F.monotonically_increasing_id())
    asked = rows.where(F.col("vec_id").isNotNull() & anchors)
    n, norm = rows.agg(F.count("*"), F.max("norm")).first()
    n_asked = asked.count()
    ids = [StructField("positive_id", kind), StructField("positive_score", LongType())]
    wanted = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    mined = StructType([StructField("anchor", LongType()), StructField("anchor_id", kind), StructField("nth", LongType()), *ids,
                        StructField("number", LongType()), StructField("negative_id", kind), StructField("negative_score", LongType())])
    if not n_asked:
        return spark.createDataFrame([], mined).withColumn("rank", F.lit(1)).select(*wanted)
    primes = primes_for(int(norm * (1 + 1e-9)) + 1)
    blocks = -(-n // row_block), -(-n_asked // anchor_block)
    plain = ["number", "vec_id", "label", "vector"]

    met = _paired(rows.select(*plain), asked.select(*plain), *blocks).mapInArrow(
        _best_positives(primes, positives), StructType([StructField("anchor", LongType()), StructField("number", LongType()), *ids]))
    first = _first_by(met, ["anchor"], "positive_score", "positive_id", positives).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    opened = stored(asked.select(*plain).join(first.withColumnRenamed("anchor", "number"), "number"))
    met = _paired(rows.select(*plain), opened, *blocks).mapInArrow(_best_negatives(primes, negatives, share), mined)
    return _first_by(met, ["anchor", "nth"], "negative_score", "negative_id", negatives).select(*wanted)
