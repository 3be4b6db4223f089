"""Language-model scores from a log-frequency Bloom filter.

Texts become *chunks* of about ``CHUNK_TOKENS`` tokens: distinct words, the
numbers of the tokens' words, and the texts' bounds, written once. A chunk asks
for each of its distinct words and bigrams once, in the bucket that the key's
hash names; what it asks with, an eight-byte key and its own training count, is what the
bucket counts, so counting and asking are one shuffle, and the answers go back in
the order of the keys.

Bigram counts are quantised to levels: every count while they are small, then
steps by ``STEP``. A Bloom filter holds a key for each level up to the n-gram's, so
reading a count means probing level after level until a probe fails. Bigrams with at
least ``threshold`` occurrences, a fixed share of the bytes of text, so at most 1 / (2 *
EPSILON) however large the corpus is, are in the filter that is broadcast to the
workers; all others are in filter segments, one for each bucket, which answers
with levels read by the same probes. Levels do not depend on where a count is
held, so the threshold decides what is broadcast and, but for false positives (about
0.1 % of absent n-grams), no score.

Bigram probabilities are interpolated with absolute discounting:

    P(w | h) = max(c(hw) - DISCOUNT, 0) / c(h) + left(h) * P(w)
    P(w)     = (1 - u) * c(w) / N,  u for an unknown word

c(hw) is the count that a bigram's level stands for, held to c(h) and c(w), which
are exact. left(h) is what all bigrams of h leave over, summed by the 32-bit half
of h that a bigram's key holds; u is the share of words seen once (Good-Turing),
the probability of the event that the next word is an unknown one. The model sees
each text through words and one end token, the first word after a start that is
not counted.

Buckets grow in number with the text. A key comes to its bucket once a chunk, so
a word or bigram that makes up a third of all tokens is as cheap as others.

Cases: null text is empty and has the end token alone; a null doc_id counts as
empty text for the split; an empty table gives an empty result; without training
texts every token is unknown; repeated rows count and are scored each; other
columns are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm.jobs import bucket_count, prepared, stored, text_bytes
from tarmac.session import ensure_checkpoint_dir, remove_folder

EPSILON = 2.0**-23      # least count of a bigram in the broadcast filter, by bytes of text
STEP = 1.25
DISCOUNT = 0.75
BITS_PER_KEY = 16
PROBES = 6
SEGMENT_BITS = 1 << 20  # of the broadcast filter; an n-gram's probes stay in one segment
CHUNK_TOKENS = 1 << 21
BROADCAST = 255         # answer for a bigram that the broadcast filter holds
FOLDS, HELD_OUT = 7, 2

START = np.uint64(0x5BF03635D1E2A7C9)
END = np.uint64(0xA24BAED4963EE407)
_HIGH = np.uint64(0xFFFFFFFF00000000)

_ASKED = "chunk long, bucket int, payload binary"
_PAIRS, _WORDS, _HISTORIES, _FREQUENT, _TOTALS = range(5)  # kinds of rows that buckets put out


def levels() -> np.ndarray:
    """Least count of each level, up to the greatest that can occur; fewer than ``BROADCAST``."""
    out = [1]
    while out[-1] < 1 << 61:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * STEP))))
    return np.array(out, dtype=np.int64)


LEVELS = levels()


def level_values() -> np.ndarray:
    """The count a level stands for, from level 0 (none): the middle of its counts, by ratio."""
    above = np.append(LEVELS[1:], np.ceil(LEVELS[-1] * STEP)) - 1
    return np.append(0.0, np.sqrt(LEVELS * above.astype(float)))


def level_of(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, count, side="right")


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first & _HIGH) | (second >> np.uint64(32))


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``text.mix``."""
    def back(x: np.ndarray, shift: int) -> np.ndarray:
        y = x
        for _ in range(64 // shift):
            y = x ^ (y >> np.uint64(shift))
        return y

    x = back(x, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = back(x, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return back(x, 30)


# ------------------------------------------------------------------ the filter

def _positions(keys: np.ndarray, level, segments: int, bits: int) -> Iterator[np.ndarray]:
    """Bit numbers of each probe, in ``segments`` segments of ``bits`` bits."""
    home = tx.bucket_of(tx.mix(keys), segments).astype(np.uint64) * np.uint64(bits)
    x = tx.mix(keys ^ (np.asarray(level, dtype=np.uint64) * np.uint64(tx.WORD_BASE)))
    at, step = x >> np.uint64(32), x | np.uint64(1)
    for _ in range(PROBES):
        yield home + ((at & np.uint64(0xFFFFFFFF)) * np.uint64(bits) >> np.uint64(32))
        at = at + step


def filled(keys: np.ndarray, low: int, high: np.ndarray, segments: int, bits: int) -> np.ndarray:
    """The bits that hold, for each key, its levels from ``low`` to ``high``."""
    held = np.zeros(segments * bits, dtype=bool)
    live = high >= low
    keys, high, level = keys[live], high[live], low
    while len(keys):
        for at in _positions(keys, level, segments, bits):
            held[at] = True
        level += 1
        keys, high = keys[high >= level], high[high >= level]
    return held


def probe(held: np.ndarray, low: int, keys: np.ndarray, segments: int, bits: int) -> np.ndarray:
    """Level of each key: probes level ``low`` and on until one fails (``low`` - 1 if the first does)."""
    out = np.full(len(keys), low - 1, dtype=np.int64)
    live, level = np.arange(len(keys)), low
    while len(live):
        found = np.ones(len(live), dtype=bool)
        for at in _positions(keys[live], level, segments, bits):
            found &= held[at]
        live = live[found]
        out[live] = level
        level += 1
    return out


# ------------------------------------------------------------------ chunks

def tokens_of(t: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words and one end for each row), and their number by row."""
    w = tx.words_of(t, lower=True)
    return np.insert(w.hash, w.first[1:], END), np.diff(w.first) + 1


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk: ids, held_out, tokens by row, distinct words, words of the tokens."""
    parts: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        ids, held, hashes, sizes = zip(*parts)
        types, of_token = tx.numbered(np.concatenate([*hashes, [START]]))
        rows = pa.array([0, sum(map(len, ids))], type=pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(rows, pa.concat_arrays(ids)), pa.ListArray.from_arrays(rows, pa.concat_arrays(held)),
            *(pa.array([x.tobytes()], type=pa.binary()) for x in (np.concatenate(sizes).astype(np.uint32), types, of_token[:-1])),
        ], names=["ids", "held_out", "sizes", "types", "tokens"])

    for batch in batches:
        for t in tx.slices(batch.column(2)):
            h, n = tokens_of(t)
            parts.append((batch.column(0).slice(t.start, t.stop - t.start), batch.column(1).slice(t.start, t.stop - t.start), h, n))
            size += len(h)
            if size >= CHUNK_TOKENS:
                yield flush()
                parts, size = [], 0
    if parts:
        yield flush()


class Chunk(NamedTuple):
    sizes: np.ndarray    # tokens by row
    train: np.ndarray    # by token
    types: np.ndarray    # distinct word hashes, in order, the start among them
    of_token: np.ndarray
    start: int           # its place among the types
    trained: int         # training rows


def _chunk(held_out, sizes, types, tokens) -> Chunk:
    held = held_out.values.to_numpy(zero_copy_only=False).astype(bool)
    sizes, types, tokens = (np.frombuffer(x.as_buffer(), dtype=k) for x, k in ((sizes, np.uint32), (types, np.uint64), (tokens, np.uint32)))
    return Chunk(sizes.astype(np.int64), np.repeat(~held, sizes), types, tokens, int(np.searchsorted(types, START)), int((~held).sum()))


def _codes(c: Chunk) -> np.ndarray:
    """A number for the bigram of each token."""
    out = np.empty(len(c.of_token), dtype=np.int64)
    out[1:] = c.of_token[:-1]
    out[np.cumsum(c.sizes) - c.sizes] = c.start
    out *= len(c.types)
    out += c.of_token
    return out


def _pairs_of(c: Chunk) -> tuple[np.ndarray, ...]:
    """History and word of each distinct bigram (places among the types), their
    mixed keys, the bigrams in the order of the keys, and the bigram of each token."""
    code, of_token = tx.numbered(_codes(c))
    a, b = (x.astype(np.uint32) for x in np.divmod(code, len(c.types)))
    keys = tx.mix(pair_keys(c.types[a], c.types[b]))
    return a, b, keys, np.argsort(keys, kind="stable"), of_token


def _asks(chunk: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: the keys, sorted, and their training counts in the chunk."""
    numbers, cuts = tx.cut_by_bucket(keys, buckets)
    few = np.minimum(counts, 255).astype(np.uint8)
    payloads = []
    for x, y in zip(cuts[:-1], cuts[1:]):
        many = x + np.flatnonzero(few[x:y] == 255)  # their counts follow in full
        payloads.append(b"".join((np.int64(y - x).tobytes(), keys[x:y].tobytes(), few[x:y].tobytes(), counts[many].astype(np.int64).tobytes())))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(numbers), chunk, dtype=np.int64)), pa.array(numbers), pa.array(payloads, type=pa.binary())], names=["chunk", "bucket", "payload"])


def _asked(payloads: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of each payload, and the counts of all of them."""
    keys, counts = [], []
    for payload in payloads:
        body = payload.as_buffer()
        n = int(np.frombuffer(body, dtype=np.int64, count=1)[0])
        keys.append(np.frombuffer(body, dtype=np.uint64, count=n, offset=8))
        count = np.frombuffer(body, dtype=np.uint8, count=n, offset=8 + 8 * n).astype(np.int64)
        count[count == 255] = np.frombuffer(bytes(body[8 + 9 * n :]), dtype=np.int64)
        counts.append(count)
    return keys, np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)


def _ask_pairs(buckets: int):
    def asks(chunk: int, state: list) -> pa.RecordBatch:
        c = _chunk(*state)
        _, _, keys, order, of_token = _pairs_of(c)
        return _asks(chunk, keys[order], np.bincount(of_token[c.train], minlength=len(keys))[order], buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, *state in zip(*batch.columns):
                yield asks(chunk.as_py(), state)

    return run


def _ask_words(buckets: int):
    def asks(chunk: int, state: list) -> pa.RecordBatch:
        c = _chunk(*state)
        counts = np.bincount(c.of_token[c.train], minlength=len(c.types))
        counts[c.start] = c.trained
        return _asks(chunk, c.types, counts, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, *state in zip(*batch.columns):
                yield asks(chunk.as_py(), state)

    return run


# ------------------------------------------------------------------ buckets

def _rows(kind: np.ndarray, chunk, bucket, bodies: list[bytes]) -> pa.Table:
    return pa.table({"kind": pa.array(kind, type=pa.int32()), "chunk": pa.array(chunk, type=pa.int64()),
                     "bucket": pa.array(bucket, type=pa.int32()), "body": pa.array(bodies, type=pa.binary())})


_PUT_OUT = "kind int, chunk long, bucket int, body binary"


def _answer_pairs(threshold: int, buckets: int):
    """What a bucket of bigrams puts out: a level for each ask, what its bigrams
    take of their histories (for the word buckets), and its frequent ones."""
    def run(asks: pa.Table) -> pa.Table:
        asked, counts = _asked(asks.column("payload"))
        keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(inverse, counts, len(keys)).astype(np.int64)
        level = level_of(counts)
        often = counts >= threshold
        own = ~often & (level > 0)
        bits = max(64, int(level[own].sum()) * BITS_PER_KEY)
        answer = np.full(len(keys), BROADCAST, dtype=np.uint8)
        answer[~often] = probe(filled(keys[own], 1, level[own], 1, bits), 1, keys[~often], 1, bits)
        answer = answer[inverse]
        ends = np.cumsum([len(x) for x in asked])
        bodies = [answer[e - len(x) : e].tobytes() for x, e in zip(asked, ends.tolist())]
        chunk, bucket = asks.column("chunk").to_numpy(), asks.column("bucket").to_numpy()
        kind = np.full(len(bodies), _PAIRS)

        seen = level > 0
        half, taken = tx.count_pairs(unmix(keys[seen]) >> np.uint64(32), np.maximum(level_values()[level[seen]] - DISCOUNT, 0))
        numbers, cuts = tx.cut_by_bucket(half << np.uint64(32), buckets)
        bodies += [half[x:y].astype(np.uint32).tobytes() + taken[x:y].astype(np.float32).tobytes() for x, y in zip(cuts[:-1], cuts[1:])]
        bodies.append(keys[often].tobytes() + level[often].astype(np.uint8).tobytes())
        here = bucket[:1]
        kind = np.concatenate((kind, np.full(len(numbers), _HISTORIES), [_FREQUENT]))
        chunk = np.concatenate((chunk, np.full(len(numbers) + 1, -1)))
        return _rows(kind, chunk, np.concatenate((bucket, numbers, here)), bodies)

    return run


def _answer_words(asks: pa.Table, takers: pa.Table) -> pa.Table:
    """What a bucket of words puts out: count and left(h) for each ask, and the
    totals of its words (tokens, types, types seen once)."""
    asked, counts = _asked(asks.column("payload"))
    if not asked:
        return _rows(np.zeros(0), [], [], [])
    words, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    n = np.bincount(inverse, counts, len(words)).astype(np.int64)
    halves, taken = [np.zeros(0, dtype=np.uint64)], [np.zeros(0)]
    for body in takers.column("body"):
        body = body.as_buffer()
        k = body.size // 8
        halves.append(np.frombuffer(body, dtype=np.uint32, count=k).astype(np.uint64))
        taken.append(np.frombuffer(body, dtype=np.float32, count=k, offset=4 * k).astype(float))
    half, taken = tx.count_pairs(np.concatenate(halves), np.concatenate(taken))
    own, of_word = np.unique(words >> np.uint64(32), return_inverse=True)
    total = np.bincount(of_word, n, len(own))
    at = np.minimum(np.searchsorted(half, own), max(len(half) - 1, 0))
    took = np.where(half[at] == own, taken[at], 0.0) if len(half) else np.zeros(len(own))
    left = np.clip(1 - took / np.maximum(total, 1), 1e-3, 1)[of_word]
    left[n == 0] = 1
    ends = np.cumsum([len(x) for x in asked]).tolist()
    bodies = [n[p].tobytes() + left[p].astype(np.float32).tobytes() for p in (inverse[e - len(x) : e] for x, e in zip(asked, ends))]
    real = n[words != START]
    bodies.append(np.array([real.sum(), (real > 0).sum(), (real == 1).sum()], dtype=np.int64).tobytes())
    chunk, bucket = asks.column("chunk").to_numpy(), asks.column("bucket").to_numpy()
    return _rows(np.append(np.full(len(asked), _WORDS), _TOTALS), np.append(chunk, -1), np.append(bucket, bucket[0]), bodies)


# ------------------------------------------------------------------ the model

class Model(NamedTuple):
    name: str            # of this run
    tokens: int          # N
    types: int           # V
    unknown: float       # u
    low: int             # the broadcast filter's least level
    held: np.ndarray     # its bits
    segments: int


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([np.frombuffer(b.as_buffer(), dtype=np.int64) for b in batch.column(0)], dtype=np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(3)], names=["n", "v", "once"])


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for body in batch.column(0):
            body = body.as_buffer()
            k = body.size // 9
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(body, dtype=np.int64, count=k)),
                                              pa.array(np.frombuffer(body, dtype=np.uint8, count=k, offset=8 * k).astype(np.int64))], names=["key", "level"])


def _in_segments(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(tx.bucket_of(tx.mix(key), segments)), *batch.columns], names=["segment", "key", "level"])

    return run


def _segment(low: int, segments: int):
    def run(table: pa.Table) -> pa.Table:
        segment = table.column("segment")[0].as_py()
        keys, level = table.column("key").to_numpy().view(np.uint64), table.column("level").to_numpy()
        bits = np.zeros(SEGMENT_BITS, dtype=bool)
        level_now = low
        while len(keys):
            for at in _positions(keys, level_now, segments, SEGMENT_BITS):
                bits[(at - np.uint64(segment * SEGMENT_BITS)).astype(np.int64)] = True
            level_now += 1
            keys, level = keys[level >= level_now], level[level >= level_now]
        return pa.table({"segment": pa.array([segment], type=pa.int32()), "body": pa.array([np.packbits(bits, bitorder="little").tobytes()], type=pa.binary())})

    return run


def _broadcast_filter(frequent: DataFrame, low: int) -> tuple[np.ndarray, int]:
    """Bits (packed) and segments of the filter of frequent bigrams."""
    kept = frequent.select("body").mapInArrow(_frequent, "key long, level long")
    keys = kept.agg(F.sum(F.col("level") - low + 1)).first()[0] or 0
    segments = max(1, -(-keys * BITS_PER_KEY // SEGMENT_BITS))
    held = np.zeros(segments * SEGMENT_BITS // 8, dtype=np.uint8)
    dealt = kept.mapInArrow(_in_segments(segments), "segment int, key long, level long")
    for segment, body in dealt.groupBy("segment").applyInArrow(_segment(low, segments), "segment int, body binary").toLocalIterator():
        held[segment * SEGMENT_BITS // 8 : (segment + 1) * SEGMENT_BITS // 8] = np.frombuffer(body, dtype=np.uint8)
    return held, segments


def _scores(model, schema_of_ids: pa.DataType):
    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(state):
            return pa.table({"doc_id": pa.array([], type=schema_of_ids), "held_out": pa.array([], type=pa.bool_()),
                             **{k: pa.array([], type=pa.int64()) for k in ("n_tokens", "n_known")}, **{k: pa.array([], type=pa.float64()) for k in ("base_score", "score")}})
        m = Model(*model.value)
        name, held = tx.worker_cache().get("lm filter", (None, None))
        if name != m.name:
            held = np.unpackbits(m.held, bitorder="little").view(bool)
            tx.worker_cache()["lm filter"] = m.name, held
        c = _chunk(*(state.column(k)[0] for k in ("held_out", "sizes", "types", "tokens")))
        answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kind = answers.column("kind").to_numpy()
        bodies = answers.column("body").to_pylist()
        split = int(np.searchsorted(kind, _WORDS))
        level = np.frombuffer(b"".join(bodies[:split]), dtype=np.uint8)
        n, left = [], []
        for body in bodies[split:]:
            k = len(body) // 12
            n.append(np.frombuffer(body, dtype=np.int64, count=k))
            left.append(np.frombuffer(body, dtype=np.float32, count=k, offset=8 * k).astype(float))
        n, left = np.concatenate(n), np.concatenate(left)

        a, b, keys, order, of_token = _pairs_of(c)
        found = np.empty(len(keys), dtype=np.uint8)
        found[order] = level
        often = np.flatnonzero(found == BROADCAST)
        found[often] = probe(held, m.low, keys[often], m.segments, SEGMENT_BITS)
        del keys, order, often  # what the bigrams no longer need goes, as each array is many megabytes
        alone = np.where(n > 0, (1 - m.unknown) * n / max(m.tokens, 1), m.unknown)
        logs = np.minimum(level_values()[found], np.minimum(n[a], n[b]))
        logs -= DISCOUNT
        np.maximum(logs, 0, out=logs)
        logs /= np.maximum(n[a], 1)
        rest = left[a]
        rest *= alone[b]
        logs += rest
        del a, b, found, rest
        np.log10(np.minimum(logs, 1.0, out=logs), out=logs)
        base = np.log10((n + 1) / float(m.tokens + m.types + 1))
        row = np.repeat(np.arange(len(c.sizes)), c.sizes)
        by_row = lambda x: np.bincount(row, x, len(c.sizes))
        return pa.table({
            "doc_id": state.column("ids")[0].values, "held_out": state.column("held_out")[0].values,
            "n_tokens": c.sizes, "n_known": by_row(n[c.of_token] > 0).astype(np.int64),
            "base_score": by_row(base[c.of_token]), "score": by_row(logs[of_token])})

    return run


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scored(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score. The model learns from documents that are not held out
    (crc32 of the id as text, modulo ``FOLDS``, is ``HELD_OUT``). What is written
    on the way is removed; the result is stored."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = prepared(docs)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    split = docs.select("doc_id", (fold == HELD_OUT).alias("held_out"), "text")
    size = text_bytes(docs)
    threshold = max(1, int(np.ceil(size * EPSILON)))
    low = int(level_of(np.array([threshold]))[0])
    threshold = int(LEVELS[low - 1])  # whole levels are broadcast
    buckets = bucket_count(size)
    kind = docs.schema["doc_id"].dataType
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lm_{uuid.uuid4().hex}"
    try:
        chunks = split.mapInArrow(_chunk_rows, StructType([
            StructField("ids", ArrayType(kind)), StructField("held_out", ArrayType(BooleanType())),
            *(StructField(c, BinaryType()) for c in ("sizes", "types", "tokens"))]))
        state = _written(chunks.withColumn("chunk", F.monotonically_increasing_id()), f"{folder}/chunks")
        seen = state.select("chunk", "held_out", "sizes", "types", "tokens")
        pairs = _written(seen.mapInArrow(_ask_pairs(buckets), _ASKED).groupBy("bucket")
                         .applyInArrow(_answer_pairs(threshold, buckets), _PUT_OUT), f"{folder}/pairs")
        takers = pairs.where(F.col("kind") == _HISTORIES).select("bucket", "body")
        words = _written(seen.mapInArrow(_ask_words(buckets), _ASKED).groupBy("bucket").cogroup(takers.groupBy("bucket"))
                         .applyInArrow(_answer_words, _PUT_OUT), f"{folder}/words")
        tokens, types, once = (x or 0 for x in words.where(F.col("kind") == _TOTALS).select("body").mapInArrow(
            _totals, "n long, v long, once long").agg(F.sum("n"), F.sum("v"), F.sum("once")).first())
        held, segments = _broadcast_filter(pairs.where(F.col("kind") == _FREQUENT), low)
        model = spark.sparkContext.broadcast(tuple(Model(folder, tokens, types, min(0.5, max(once, 1) / (tokens + 1)), low, held, segments)))
        answers = pairs.where(F.col("kind") == _PAIRS).unionByName(words.where(F.col("kind") == _WORDS))
        out = state.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scores(model, to_arrow_type(kind)), StructType([
            StructField("doc_id", kind), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()), StructField("n_known", LongType()),
            StructField("base_score", DoubleType()), StructField("score", DoubleType())]))
        return stored(out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"))
    finally:
        remove_folder(spark, folder)
