"""MinHash near-dedup by a signature-coordinate inverted join.

Documents (lower-cased A-Z) become sets of 5-word shingles and signatures of
``COORDINATES`` minima. Documents with equal sets are one class from then on,
so a text copied a million times is one row.

1. Each class is posted under every (coordinate, value) of its signature.
   Lists of one are dropped; a class left with fewer than ``MATCHES`` postings
   cannot match any other in that many coordinates and is skipped.
2. Prefix: a class with s postings needs only its s - MATCHES + 1 shortest
   lists, as two classes that share MATCHES of them meet in these prefixes.
3. Merging with skips: in each list, members are first compared with one
   leader, the member that shares most postings with others. The lists of one
   leader are then merged, so a class is in each merged list once. Members that
   the links found so far already connect are skipped; only members of different
   components are compared, block by block inside tasks, and a pair is put out
   once, by the least leader both have.
4. A comparison counts agreements of 256 further minima (one byte each, kept
   for classes that got this far). Of pairs with ``SKETCH_MATCHES`` or more,
   small sets (at most ``FEW`` shingles, which travel as 32-bit hashes) are
   compared at once, best agreement first, and pairs that the links found in
   the block connect already are skipped; others are put out. All that is put
   out is confirmed on full sets: 100 * intersection >= 75 * union.

A pair of similarity 0.75 is missed with a chance of about 3e-5, a closer one
with less. Nothing is capped. A near-copy group costs its size for the leader
and, for members that are not linked to it, comparisons inside tasks.

Cases: null text or one without words has an empty set, n_shingles 0, and
links with nothing (component_id is its own id); fewer than five words are one
shingle; repeated rows are copies; a null doc_id never names a component while
there is another id; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm.components import components
from tarmac.llm.jobs import prepared, stored
from tarmac.llm.lists import groups, in_blocks, meets_before

SHINGLE = 5
COORDINATES = 64
MATCHES = 34
SKETCH = 256           # further coordinates, one byte each
SKETCH_MATCHES = 162   # a similarity of 0.75 gives 192, with a deviation of 7
PERCENT = 75
FEW = 256
BLOCK_ROWS = 2048      # members of a list compared together

_MULTIPLIERS = tx.mix(np.arange(1, COORDINATES + SKETCH + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(t: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's distinct shingles, in order, and each row's bounds."""
    w = tx.words_of(t, lower=True)
    n = np.diff(w.first)
    grams = tx.hash_windows(w.hash, SHINGLE)
    many = np.maximum(n - SHINGLE + 1, 0)
    h = [grams[tx.ragged(w.first[:-1], many)]]
    row = [np.repeat(np.arange(len(n)), many)]
    for k in range(1, SHINGLE):  # the whole text as one
        at = np.flatnonzero(n == k)
        if len(at):
            h.append(tx.hash_windows(w.hash, k)[w.first[at]])
            row.append(at)
    h, row = np.concatenate(h), np.concatenate(row)
    order = np.argsort(h)
    row = row.astype(np.uint16 if len(n) < 1 << 16 else np.int64)
    order = order[np.argsort(row[order], kind="stable")]
    h, row = h[order], row[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
        h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(n) + 1))


def set_keys(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each row's set; 0 for an empty one."""
    n = np.diff(first)
    out = np.zeros(len(n), dtype=np.uint64)
    at = np.flatnonzero(n)
    if len(at):
        out[at] = tx.mix(np.add.reduceat(h, first[at]) ^ n[at].astype(np.uint64) * np.uint64(tx.BYTE_BASE))
    return out.view(np.int64)


def _minima(h: np.ndarray, first: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Rows x multipliers; rows with an empty set are left out."""
    at = first[:-1][np.diff(first) > 0]
    out = np.empty((len(at), len(multipliers)), dtype=np.uint32)
    for j, m in enumerate(multipliers):
        out[:, j] = np.minimum.reduceat((h * m >> np.uint64(32)).astype(np.uint32), at)
    return out


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _minima(h, first, _MULTIPLIERS[:COORDINATES])


def sketches(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A mixed byte of each further minimum."""
    return (tx.mix(_minima(h, first, _MULTIPLIERS[COORDINATES:]).astype(np.uint64)) & np.uint64(255)).astype(np.uint8)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in tx.slices(batch.column(2)):
            h, first = shingle_sets(t)
            n = np.diff(first)
            sig = np.zeros(len(n), dtype=object)
            sig[:] = None
            full = np.flatnonzero(n)
            if len(full):
                sig[full] = [x.tobytes() for x in signatures(h, first)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i).slice(t.start, t.stop - t.start) for i in range(2)),
                pa.array(n, type=pa.int64()), pa.array(set_keys(h, first)), pa.array(sig, type=pa.binary()),
            ], names=["doc_id", "text_key", "n_shingles", "key", "signature"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(post, key): post is a mixed (coordinate, value)."""
    place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
        post = tx.mix((sig.astype(np.uint64) | place).ravel()).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(post), pa.array(np.repeat(batch.column(0).to_numpy(), COORDINATES))], names=["post", "key"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in tx.slices(batch.column(0)):
            h, first = shingle_sets(t)
            full = np.flatnonzero(np.diff(first))
            if len(full):
                yield pa.RecordBatch.from_arrays([
                    pa.array(set_keys(h, first)[full]),
                    pa.array([h[first[r] : first[r + 1]].tobytes() for r in full], type=pa.binary()),
                    pa.array([x.tobytes() for x in sketches(h, first)], type=pa.binary()),
                    pa.array([(h[first[r] : min(first[r] + FEW + 1, first[r + 1])] >> np.uint64(32)).astype(np.uint32).tobytes()
                              for r in full], type=pa.binary()),
                ], names=["key", "shingles", "sketch", "few"])


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree enough."""
    for batch in batches:
        if batch.num_rows:
            agree = (_sketches(batch.column(2)) == _sketches(batch.column(3))).sum(axis=1)
            yield batch.select([0, 1]).filter(pa.array(agree >= SKETCH_MATCHES))


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each group whose members are of different components and whose
    sketches agree enough, if no lesser leader has both; of small sets only links
    that join what is not joined yet."""
    for g in groups(batches, ["leader", "low", "high"]):
        here, low, high = (g.column(c)[0].as_py() for c in ("leader", "low", "high"))
        part, key, root = (g.column(c).to_numpy() for c in ("part", "key", "root"))
        sketch = _sketches(g.column("sketch"))
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        i, j, agree = [], [], []
        for r in left:
            others = right[root[right] != root[r]]
            if low == high:
                others = others[others > r]
            same = (sketch[others] == sketch[r]).sum(axis=1)
            others, same = others[same >= SKETCH_MATCHES], same[same >= SKETCH_MATCHES]
            i.append(np.full(len(others), r))
            j.append(others)
            agree.append(same)
        i, j, agree = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64) for x in (i, j, agree))
        if len(i):
            names = [np.asarray(x, dtype=np.int64) for x in g.column("leaders").to_pylist()]
            new = np.flatnonzero(~meets_before(names, i, j, here))
            new = new[np.argsort(-agree[new], kind="stable")]
            keep = _joining(i[new], j[new], root, [np.frombuffer(x, dtype=np.uint32) for x in g.column("few").to_pylist()])
            if keep:
                yield pa.RecordBatch.from_arrays([pa.array(key[i[new[keep]]]), pa.array(key[j[new[keep]]])], names=["a", "b"])


def _joining(i: np.ndarray, j: np.ndarray, root: np.ndarray, few: list[np.ndarray]) -> list[int]:
    """Places of the pairs to put out: links of small sets between what is not
    joined yet, and all pairs with a larger set."""
    joined: dict[int, int] = {}

    def find(x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    out = []
    for n, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = find(int(root[a])), find(int(root[b]))
        if x == y:
            continue
        if max(len(few[a]), len(few[b])) > FEW:
            out.append(n)
            continue
        both = len(np.intersect1d(few[a], few[b], assume_unique=True))
        if 100 * both >= PERCENT * (len(few[a]) + len(few[b]) - both):
            out.append(n)
            joined[x] = y
    return out


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))


def _joined(pairs: DataFrame, side: DataFrame, value: str) -> DataFrame:
    """Pairs (a, b) with a value of both."""
    for k in ("a", "b"):
        pairs = pairs.join(side.select(F.col("key").alias(k), F.col(value).alias(f"{value}_{k}")), k)
    return pairs.select("a", "b", f"{value}_a", f"{value}_b")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    return stored(_joined(pairs, sets, "shingles").mapInArrow(_similar, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and
    ``key`` (the name of its set, null if empty) and ``text_key``."""
    prepared(docs)
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    described = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(
        StructField(c, LongType()) for c in ("text_key", "n_shingles", "key")), StructField("signature", BinaryType())])
    told = stored(keyed.mapInArrow(_describe, described))
    classes = stored(
        told.where("n_shingles > 0").groupBy("key")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key")).alias("one"),
             F.min("signature").alias("signature")))

    # cheap to make again from the stored signatures, so not stored
    posts = classes.select("key", "signature").mapInArrow(_postings, "post long, key long")
    lengths = stored(posts.groupBy("post").agg(F.count("*").alias("n")).where("n > 1"))
    of_class = (
        posts.join(lengths, "post").groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("posts"),  # COORDINATES at most
             F.sum("n").alias("shared"))
        .where(F.size("posts") >= MATCHES)
    )
    prefixes = stored(of_class.select(
        "key", "shared", F.expr(f"slice(posts, 1, size(posts) - {MATCHES - 1}).post").alias("posts")))
    prefix = prefixes.select("key", "shared", F.explode("posts").alias("post"))

    wanted = stored(classes.join(prefixes.select("key"), "key", "left_semi").select(
        F.col("one.doc_id").alias("id"), F.col("one.text_key").alias("tk")))
    texts = keyed.join(wanted, keyed["doc_id"].eqNullSafe(wanted["id"]) & (keyed["text_key"] == wanted["tk"]), "left_semi")
    sets = stored(texts.select("text").mapInArrow(_sets, "key long, shingles binary, sketch binary, few binary")
                  .groupBy("key").agg(*[F.first(c).alias(c) for c in ("shingles", "sketch", "few")]))

    leaders = stored(prefix.groupBy("post").agg(F.max(F.struct("shared", "key")).alias("most"))
                     .select("post", F.col("most.key").alias("a")))
    # the members of all lists of one leader, each once
    led = stored(prefix.join(leaders, "post").select(F.col("a").alias("leader"), "key").distinct())
    first = led.where("leader != key").select(F.col("leader").alias("a"), F.col("key").alias("b"))
    near = stored(_joined(first, sets, "sketch").mapInArrow(_agreeing, "a long, b long"))
    links = _confirmed(near, sets)
    roots = stored(components(links))

    placed = led.join(roots.withColumnsRenamed({"id": "key"}), "key", "left").select(
        "leader", "key", F.coalesce("root", "key").alias("root"))
    mixed = stored(placed.groupBy("leader").agg((F.min("root") != F.max("root")).alias("open")).where("open").select("leader"))
    members = stored(placed.join(mixed, "leader", "left_semi"))
    about = stored(led.groupBy("key").agg(F.collect_list("leader").alias("leaders"))  # COORDINATES at most
                   .join(members.select("key").distinct(), "key", "left_semi")
                   .join(sets.select("key", "sketch", "few"), "key"))
    crossing = in_blocks(members, "leader", "key", BLOCK_ROWS, about).mapInArrow(_crossing, "a long, b long")
    more = _confirmed(stored(crossing), sets)
    if not more.isEmpty():
        roots = stored(components(links.unionByName(more)))

    named = classes.select("key", "least_id").join(roots.withColumnsRenamed({"id": "key"}), "key", "left").select(
        "key", F.coalesce("root", "key").alias("root"), "least_id")
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_key = stored(named.join(stored(names), "root").select("key", "component_id"))
    out = told.select("doc_id", "n_shingles", "text_key", F.when(F.col("n_shingles") > 0, F.col("key")).alias("key")).join(of_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "key", "text_key")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component left (the kept one; of
    repeated rows one)."""
    found = stored(near_duplicates(docs).where("kept").groupBy("doc_id", "text_key")
                   .agg(F.count("*").alias("rows"), F.max("n_shingles").alias("n")))
    keyed = docs.withColumn("_mh_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    one = found.select(F.col("doc_id").alias("_mh_id"), F.col("text_key").alias("_mh_text"))
    left = keyed.join(one, keyed["doc_id"].eqNullSafe(one["_mh_id"]) & (keyed["_mh_key"] == one["_mh_text"]), "left_semi")
    if not found.where("rows > 1 and n > 0").isEmpty():  # repeated rows have one id and text
        left = left.dropDuplicates(["doc_id", "_mh_key"])
    return left.drop("_mh_key")
