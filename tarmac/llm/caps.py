"""Embedding near-dedup by spherical-cap filters of a random product code.

The space is rotated at random and cut into two blocks; each block has ``words``
random unit vectors, and every combination of one per block is a filter
direction, words ** 2 of them, about as many as there are vectors.
A vector is *list-decoded* to all directions whose cap holds it: block scores
are sorted and only combinations that reach the threshold are walked. The
threshold is set so that a random vector has about ``FILTERS`` filters; a vector
with fewer than ``LEAST_FILTERS`` takes its best ones, so none is lost.

Vectors are joined on filters, and pairs that meet are verified by the cosine in
double precision. Copies of a vector are one class from the start. Dense groups
are *clusters*: every class looks up the leader of its filters that has most
company, and joins its cluster if the angle between them is at most half of the
linking angle. Two members of a cluster then link for certain, so they are counted by the
cluster's size and never compared; only classes of different clusters are, in
filters that hold more than one. In a filter with more than ``BLOCK_ROWS``
classes these are dealt to blocks and compared block by block, but for blocks of the
filter's largest cluster with each other. No pair is put out: a pair is counted
in the least filter that it shares, and each group gives only a number of links
and a local root for each class; roots become components.

Links are exact when found; the share of pairs found is measured against brute
force in the tests (0.99 or more on the test tables).

Cases: vectors that are null, empty, zero or hold null or non-finite values link
with nothing, n_links 0; vectors of different lengths never link; repeated rows
are copies; a null vec_id never names a component while there is another id;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm.components import components
from tarmac.llm.jobs import prepared, stored
from tarmac.llm.lists import groups, meets_before

COSINE = 0.95
FILTERS = 24
LEAST_FILTERS = 16
BLOCK_ROWS = 1024
DECODE_ROWS = 256
SEED = 20_021
TUNE_ROWS = 4096     # random vectors that set the threshold


def _columns(schema: str) -> StructType:
    kinds = {"long": LongType(), "int": IntegerType(), "binary": BinaryType()}
    return StructType([StructField(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


class Code:
    """A product code of two blocks for vectors of ``dim`` values (one block
    if there is one value)."""

    def __init__(self, dim: int, words: int) -> None:
        rng = np.random.default_rng([SEED, dim, words])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cut = dim // 2
        self.words = []
        for size in (self.cut, dim - self.cut):
            w = rng.standard_normal((words if size else 1, size))
            self.words.append(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300))
        self.size = len(self.words[0]) * len(self.words[1])
        x = rng.standard_normal((TUNE_ROWS, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        most = 4 * 64 * FILTERS
        # a sum of the i-th and j-th best scores has i * j - 1 others of its row above it,
        # so the best ``most`` sums are among these, however many words there are
        wide = [min(len(w), most) for w in self.words]
        reach = np.minimum(most // np.arange(1, wide[0] + 1), wide[1])
        i_a, i_b = np.repeat(np.arange(wide[0]), reach), tx.ragged(np.zeros(wide[0], dtype=np.int64), reach)
        best = []
        for i in range(0, TUNE_ROWS, 64):
            a, b = (-np.sort(-s, axis=1) for s in self.scores(x[i : i + 64]))
            sums = (a[:, i_a] + b[:, i_b]).ravel()
            k = min(most, len(sums))
            best.append(np.partition(sums, len(sums) - k)[len(sums) - k :].copy())
        best = np.sort(np.concatenate(best))
        self.least = float(best[max(0, len(best) - FILTERS * TUNE_ROWS)])

    def scores(self, x: np.ndarray) -> list[np.ndarray]:
        x = x @ self.turn
        return [x[:, : self.cut] @ self.words[0].T, x[:, self.cut :] @ self.words[1].T]

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter number, in order, of all caps that hold the rows."""
        a, b = self.scores(x)
        order_a, order_b = np.argsort(-a, axis=1), np.argsort(-b, axis=1)
        a, b = np.take_along_axis(a, order_a, 1), np.take_along_axis(b, order_b, 1)
        # the best LEAST_FILTERS sums are among the first of both blocks
        head = (a[:, :LEAST_FILTERS, None] + b[:, None, :LEAST_FILTERS]).reshape(len(x), -1)
        k = min(LEAST_FILTERS, head.shape[1])
        bound = np.minimum(np.partition(head, -k, axis=1)[:, -k], self.least)
        rows, names = [], []
        live = np.arange(len(x))
        for rank in range(a.shape[1]):  # walk the first block while it can reach the bound
            live = live[a[live, rank] + b[live, 0] >= bound[live]]
            if not len(live):
                break
            reach = (a[live, rank][:, None] + b[live] >= bound[live][:, None]).sum(axis=1)
            rows.append(np.repeat(live, reach))
            at = tx.ragged(np.zeros(len(live), dtype=np.int64), reach)
            names.append(order_a[rows[-1], rank] * b.shape[1] + order_b[rows[-1], at])
        rows, names = np.concatenate(rows), np.concatenate(names)
        order = np.lexsort((names, rows))
        return rows[order], names[order]


def code_for(dim: int, words: int) -> Code:
    cache = tx.worker_cache()
    key = f"caps:{dim}:{words}"
    if key not in cache:
        cache[key] = Code(dim, words)
    return cache[key]


def words_for(vectors: int) -> int:
    """Words of a block, for about as many filters as vectors."""
    return max(8, int(np.ceil(vectors ** 0.5)))


def _read(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each row's vector in double precision, or None if it links with nothing."""
    for v in column:
        if not v.is_valid or not len(v.values):
            yield None
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        scale = np.abs(x).max()
        yield x if v.values.null_count == 0 and np.isfinite(x).all() and scale > 0 else None


def unit(x: np.ndarray) -> np.ndarray:
    """The vector's direction; scaled first, so that no square overflows."""
    x = x / np.abs(x).max()
    return x / np.sqrt((x * x).sum())


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, key, vector): the key names the vector, null if it links with nothing."""
    for batch in batches:
        raw = [None if x is None else x.tobytes() for x in _read(batch.column(1))]
        data, off = tx.byte_view(pa.array([r or b"" for r in raw], type=pa.large_binary()))
        full = np.flatnonzero(np.diff(off))
        keys = np.zeros(len(raw), dtype=np.int64)
        keys[full] = tx.hash_spans(data, off[:-1][full], off[1:][full]).view(np.int64)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(keys, mask=np.diff(off) == 0), pa.array(raw, type=pa.binary())],
            names=["vec_id", "key", "vector"])


def _coded(words: int):
    """Each class's direction and its filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.frombuffer(v.as_buffer(), dtype=np.float64) for v in batch.column(2)]
            for dim in sorted({len(v) for v in vectors}):
                own = np.array([i for i, v in enumerate(vectors) if len(v) == dim])
                for at in range(0, len(own), DECODE_ROWS):
                    part = own[at : at + DECODE_ROWS]
                    x = np.stack([unit(vectors[i]) for i in part])
                    row, names = code_for(dim, words).decode(x)
                    names = names * 65_536 + dim  # filters of another length are others
                    ends = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                    place = pa.array(part)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(place), batch.column(1).take(place), pa.array([v.tobytes() for v in x], type=pa.binary()),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(names))],
                        names=["key", "copies", "vector", "filters"])

    return run


def sure_cosine(cosine: float) -> float:
    """The cosine of half the angle, and a little more than rounding takes."""
    return float(np.sqrt((1 + cosine) / 2)) + 1e-9


def _close(least: float):
    """Rows whose two vectors have a cosine of ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool(np.frombuffer(a.as_buffer()) @ np.frombuffer(b.as_buffer()) >= least) for a, b in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))

    return run


def clusters(coded: DataFrame, cosine: float) -> DataFrame:
    """(key, cluster) of classes near the leader of a cluster. A filter's leader
    is the member with most company (the sizes of its filters together), and a
    class asks the leader with most company among its filters'."""
    post = coded.select("key", F.explode("filters").alias("filter"))
    sizes = stored(post.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1"))
    company = post.join(sizes, "filter").groupBy("key").agg(F.sum("n").alias("company"))
    told = stored(coded.select("key", "filters").join(company, "key"))
    post = told.select("key", "company", F.explode("filters").alias("filter"))
    leaders = stored(post.groupBy("filter").agg(F.max(F.struct("company", "key")).alias("leader"), F.count("*").alias("n"))
                     .where("n > 1").select("filter", "leader"))
    asked = (post.join(leaders, "filter").groupBy("key").agg(F.max("leader").alias("leader"))
             .select("key", F.col("leader.key").alias("cluster")).where("key != cluster"))
    own = coded.select("key", F.col("vector").alias("own"))
    theirs = coded.select(F.col("key").alias("cluster"), F.col("vector").alias("theirs"))
    met = asked.join(own, "key").join(theirs, "cluster").select("key", "cluster", "own", "theirs")
    return stored(met.mapInArrow(_close(sure_cosine(cosine)), _columns("key long, cluster long")))


def _mixed(members: DataFrame, about: DataFrame, block_rows: int) -> DataFrame:
    """Members (filter, key, cluster) of filters with more than one cluster, in
    groups (filter, low, high) in which every pair of different clusters meets once.
    A large filter's members are dealt to parts: first those outside its largest
    cluster, which meet all, then those of it, which meet only the others."""
    by_cluster = members.groupBy("filter", "cluster").agg(F.count("*").alias("n"))
    sizes = by_cluster.groupBy("filter").agg(F.sum("n").alias("n"), F.max(F.struct("n", "cluster")).alias("most"), F.count("*").alias("clusters"))
    sizes = stored(sizes.where("clusters > 1").select(
        "filter", F.when(F.col("n") > block_rows, F.col("most.cluster")).alias("largest"),
        F.ceil(F.when(F.col("n") > block_rows, F.col("n") - F.col("most.n")).otherwise(1) / block_rows).cast("int").alias("others"),
        F.ceil(F.col("most.n") / block_rows).cast("int").alias("blocks")))
    of_largest = F.coalesce(F.col("cluster") == F.col("largest"), F.lit(False))
    part = F.when(of_largest, F.col("others") + F.pmod(F.xxhash64("key"), "blocks")).otherwise(F.pmod(F.xxhash64("key"), "others")).cast("int")
    meets = F.when(of_largest | F.col("largest").isNull(), F.col("others")).otherwise(F.col("others") + F.col("blocks"))
    dealt = (members.join(sizes, "filter").withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1))))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    return (dealt.select("filter", "key", "cluster", "part", low, high).join(about, "key")
            .repartition("filter", "low", "high").sortWithinPartitions("filter", "low", "high"))


def _verified(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["filter", "low", "high"]):
            yield from _linked(g, cosine)

    return run


def _linked(g: pa.Table, cosine: float) -> Iterator[pa.RecordBatch]:
    """(key, links, root) of the classes that have a link in the group."""
    here, low, high = (g.column(c)[0].as_py() for c in ("filter", "low", "high"))
    part, keys, copies, cluster = (g.column(c).to_numpy() for c in ("part", "key", "copies", "cluster"))
    x = np.frombuffer(b"".join(g.column("vector").to_pylist()), dtype=np.float64).reshape(len(keys), -1)
    left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
    close = x[left] @ x[right].T >= cosine
    if low == high:
        close = np.triu(close, 1)
    close &= cluster[left][:, None] != cluster[right]
    i, j = np.nonzero(close)
    if not len(i):
        return
    i, j = left[i], right[j]
    order = np.argsort(keys)
    root = np.empty(len(keys), dtype=np.int64)
    root[order] = np.arange(len(keys))
    before = None
    while before is None or (root != before).any():  # least rank reachable
        before = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = np.minimum(root, root[order[root]])
    names = [v.values.to_numpy() for v in g.column("filters")]
    new = ~meets_before(names, i, j, here)
    links = np.zeros(len(keys), dtype=np.int64)
    np.add.at(links, i[new], copies[j[new]])
    np.add.at(links, j[new], copies[i[new]])
    keep = np.unique(np.concatenate((i, j)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys[keep]), pa.array(links[keep]), pa.array(keys[order[root[keep]]])], names=["key", "links", "root"])


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    prepared(vectors)
    vectors = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("vector"))
    kind = vectors.schema["vec_id"].dataType
    keyed = stored(vectors.mapInArrow(_keyed, StructType([
        StructField("vec_id", kind), StructField("key", LongType()), StructField("vector", BinaryType())])))
    classes = stored(keyed.where("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector")))

    words = words_for(classes.count())
    coded = stored(classes.select("key", "copies", "vector").mapInArrow(_coded(words), StructType(
        [*_columns("key long, copies long, vector binary").fields, StructField("filters", ArrayType(LongType()))])))
    near = clusters(coded, cosine)
    placed = stored(coded.select("key", "copies", "filters").join(near, "key", "left")
                    .select("key", "copies", "filters", F.coalesce("cluster", "key").alias("cluster")))
    members = placed.select("key", "cluster", F.explode("filters").alias("filter"))
    found = stored(_mixed(members, coded, BLOCK_ROWS).mapInArrow(_verified(cosine), _columns("key long, links long, root long")))

    joined = found.select(F.col("key").alias("a"), F.col("root").alias("b"))
    roots = stored(components(joined.unionByName(near.select(F.col("key").alias("a"), F.col("cluster").alias("b")))))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    sizes = placed.groupBy("cluster").agg(F.sum("copies").alias("size"))
    named = (placed.select("key", "cluster").join(sizes, "cluster").join(classes.select("key", "least_id"), "key")
             .join(links, "key", "left").join(roots.withColumnsRenamed({"id": "key"}), "key", "left")
             .select("key", F.coalesce("root", "key").alias("root"), "least_id",
                     (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    names = stored(named.groupBy("root").agg(F.min("least_id").alias("component_id")))
    of_key = stored(named.join(names, "root").select("key", "n_links", "component_id"))
    out = keyed.select("vec_id", "key").join(of_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
