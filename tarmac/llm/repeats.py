"""Substring dedup on a compacted de Bruijn graph of words.

An edge is a window of ``k`` consecutive words of one document, a node the
k - 1 words that two edges share. Edges that occur more than once are the
repeated content.

1. Every window is dealt to the bucket of its *minimizer*, the 16-word run in
   it with the least hash (leftmost at a tie). Equal windows have equal
   minimizers, so they meet; neighbouring windows mostly share one, so they
   travel as one packed piece with their source coordinates. A task counts its
   own windows before the shuffle and sends each distinct one once, so a
   passage found in a third of all documents is a few entries per task.
2. A bucket finds the edges that occur again and compacts those that follow
   one another in a source into paths (text, start, length).
3. Paths are glued across buckets by a grouping on the source text, and joined
   with the texts; source coordinates give the covered words.

Windows are identified by 64 bits, into which the 64 of the minimizer and 48 of the
window are folded; texts by 64 bits. Nothing is collected and nothing is capped; a bucket holds
the windows of about 16 MB of text at any size of input.

Cases: null text counts as no words and becomes empty; a text of fewer than
``k`` words has no window and keeps its words; rows repeated or with one
doc_id are documents of their own; null ids stay; an empty table gives an
empty result; other columns pass through, except that ``text`` is replaced and
``n_words`` and ``n_removed`` are set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm.jobs import bucket_count, prepared, stored, text_bytes

K = 35
ANCHOR = 16                # words of a minimizer
FLUSH_WINDOWS = 1 << 21    # windows counted together in a task
PIECE = 1 << 22            # words whose minimizers are found together

_HEAD = 3
_MAPPED = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
_PATHS = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("edges", pa.int32())])


def minimizers(words: np.ndarray, k: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``k`` words: place and hash of its minimizer."""
    grams = tx.hash_windows(words, anchor)
    span = k - anchor + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), grams[:0]
    low = np.uint64((1 << 24) - 1)
    place = np.empty(n, dtype=np.int64)
    for at in range(0, n, PIECE):
        m = min(PIECE, n - at)
        part = grams[at : at + m + span - 1]
        # order: hash without its low bits, then place
        best = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width < span:
            best = np.minimum(best[:m], best[span - width : span - width + m])
        place[at : at + m] = (best[:m] & low).astype(np.int64) + at
    return place, grams[place]


class _Flush:
    """Windows of some texts, gathered until there are enough to count."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, t: tx.Texts, keys: np.ndarray, k: int) -> None:
        w = tx.words_of(t)
        counts = np.diff(w.first)
        per_row = np.maximum(counts - k + 1, 0)
        if not per_row.any():
            return
        place, anchors = minimizers(w.hash, k, ANCHOR)
        prints = tx.hash_windows(w.hash, k)
        at = tx.ragged(w.first[:-1], per_row)  # windows that stay in their row
        row = np.repeat(np.arange(len(counts)), per_row)
        start = at - w.first[:-1][row]
        self.parts.append((anchors[at], prints[at], keys[row], start.astype(np.int32), place[at] - at + start))
        self.size += len(at)

    def emit(self, buckets: int) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        anchor, prints, key, start, place = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        # count here: a window that occurs again here is known to be repeated
        order = np.argsort(prints, kind="stable")
        p = prints[order]
        new = np.concatenate(([True], p[1:] != p[:-1]))
        again = ~new
        twice = again.copy()
        twice[:-1] |= again[1:]
        here, send = np.zeros(len(p), dtype=bool), np.zeros(len(p), dtype=bool)
        here[order], send[order] = twice, new

        at = np.flatnonzero(here)
        cut = _runs(at, key, start)
        known = (key[at[cut]], start[at[cut]], np.diff(np.append(cut, len(at))).astype(np.int32))
        known_bucket = tx.bucket_of(tx.mix(known[0].view(np.uint64)), buckets)

        at = np.flatnonzero(send)
        cut = _runs(at, key, start, place)
        lengths = np.diff(np.append(cut, len(at)))
        first = at[cut]
        bucket = tx.bucket_of(tx.mix(anchor[first]), buckets)

        o, ko = np.argsort(bucket, kind="stable"), np.argsort(known_bucket, kind="stable")
        ends, known_ends = (np.searchsorted(b, np.arange(buckets + 1)) for b in (bucket[o], known_bucket[ko]))
        ids, payloads = [], []
        for b in range(buckets):
            mine, told = o[ends[b] : ends[b + 1]], ko[known_ends[b] : known_ends[b + 1]]
            if not len(mine) and not len(told):
                continue
            f = first[mine]
            own = at[tx.ragged(cut[mine], lengths[mine])]
            fp = prints[own]
            ids.append(b)
            payloads.append(b"".join(x.tobytes() for x in (
                np.array([len(mine), len(own), len(told)], dtype=np.int64),
                anchor[f], key[f], start[f], lengths[mine].astype(np.uint8),
                fp.astype(np.uint32), (fp >> np.uint64(32)).astype(np.uint16),
                known[0][told], known[1][told], known[2][told],
            )))
        yield tx.rows(_MAPPED, (ids, payloads))


def _runs(at: np.ndarray, key: np.ndarray, start: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Where a new run of consecutive windows begins among the windows ``at``."""
    if not len(at):
        return np.zeros(0, dtype=np.int64)
    same = (np.diff(at) == 1) & (np.diff(start[at]) == 1) & (np.diff(key[at]) == 0)
    if place is not None:
        same &= np.diff(place[at]) == 0
    return np.flatnonzero(np.concatenate(([True], ~same)))


def _map_windows(k: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = _Flush()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for t in tx.slices(batch.column(1)):
                flush.add(t, keys[t.start : t.stop], k)
                if flush.size >= FLUSH_WINDOWS:
                    yield from flush.emit(buckets)
        yield from flush.emit(buckets)

    return run


def _read(payload: bytes) -> tuple[np.ndarray, ...]:
    m, n, t = np.frombuffer(payload, dtype=np.int64, count=_HEAD)
    out, at = [], 8 * _HEAD
    for kind, count in ((np.uint64, m), (np.int64, m), (np.int32, m), (np.uint8, m), (np.uint32, n), (np.uint16, n), (np.int64, t), (np.int32, t), (np.int32, t)):
        out.append(np.frombuffer(payload, dtype=kind, count=count, offset=at))
        at += count * np.dtype(kind).itemsize
    return tuple(out)


def _reduce_bucket(table: pa.Table) -> pa.Table:
    parts = [_read(x) for x in table.column("payload").to_pylist()]
    anchor, key, start, length, low, high, *known = (np.concatenate(x) for x in zip(*parts))
    length = length.astype(np.int64)
    entry = np.repeat(np.arange(len(length)), length)
    ident = tx.mix(anchor[entry] ^ tx.mix((high.astype(np.uint64) << np.uint64(32)) | low))
    order = np.argsort(ident, kind="stable")
    i = ident[order]
    same = i[1:] == i[:-1]
    found = np.zeros(len(i), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    at = np.flatnonzero(found)
    offset = np.arange(len(entry)) - (np.cumsum(length) - length)[entry]
    cut = np.zeros(0, dtype=np.int64)
    if len(at):
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(entry[at]) != 0))))
    first = at[cut]
    e = entry[first]
    return pa.Table.from_arrays([
        pa.array(np.concatenate((key[e], known[0]))),
        pa.array(np.concatenate((start[e] + offset[first].astype(np.int32), known[1])).astype(np.int32)),
        pa.array(np.concatenate((np.diff(np.append(cut, len(at))), known[2])).astype(np.int32)),
    ], schema=_PATHS)


def text_key(column: str = "text"):
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def repeated_paths(docs: DataFrame, k: int = K) -> DataFrame:
    """(key, start, edges): ``edges`` windows of the text with that ``key``,
    from word ``start`` on, are repeated."""
    if k < ANCHOR:
        raise ValueError(f"k must be {ANCHOR} or more")
    buckets = bucket_count(text_bytes(docs))
    keyed = docs.select(text_key().alias("key"), "text")
    mapped = keyed.mapInArrow(_map_windows(k, buckets), "bucket int, payload binary")
    found = mapped.groupBy("bucket").applyInArrow(_reduce_bucket, "key long, start int, edges int")
    return found.groupBy("key", "start").agg(F.max("edges").alias("edges"))


def _cover(k: int, names: list[str], text_at: int, path_at: int):
    """Rewrites the texts; ``names`` are the columns of the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(path_at)
            for t in tx.slices(batch.column(text_at)):
                w_start, w_end = tx.bounds(t.data, t.offsets)
                first = np.searchsorted(w_start, t.offsets)
                own = paths.slice(t.start, t.stop - t.start)
                count = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = own.flatten()
                row = np.repeat(np.arange(len(count)), count)
                begin = first[row] + flat.field("start").to_numpy(zero_copy_only=False)
                step = np.zeros(len(w_start) + 1, dtype=np.int64)
                np.add.at(step, begin, 1)
                np.add.at(step, begin + flat.field("edges").to_numpy(zero_copy_only=False) + k - 1, -1)
                keep = np.cumsum(step)[:-1] == 0
                n = np.diff(first)
                kept = np.add.reduceat(np.append(keep, False).astype(np.int64), first[:-1]) if len(n) else n
                kept[n == 0] = 0
                text = joined(t.data, w_start[keep], w_end[keep], kept)
                columns = [batch.column(i).slice(t.start, t.stop - t.start) for i in range(batch.num_columns)]
                columns[text_at] = text
                del columns[path_at]
                columns += [pa.array(n, type=pa.int64()), pa.array(n - kept, type=pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """Each row's words joined by one space; per_row: words of each row."""
    lengths = end - start + 1
    body = np.append(data, np.uint8(32))[tx.ragged(start, lengths)]
    stop = np.cumsum(lengths) - 1
    body[stop] = 32
    last = np.cumsum(per_row)[per_row > 0] - 1
    keep = np.ones(len(body), dtype=bool)
    keep[stop[last]] = False
    total = np.concatenate(([0], np.cumsum(lengths)))
    ends = np.cumsum(per_row)
    size = total[ends] - total[ends - per_row] - (per_row > 0)
    off = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(per_row), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(body[keep]))])


def remove_repeats(docs: DataFrame, k: int = K) -> DataFrame:
    """``docs`` with each word covered by a repeated window taken out of
    ``text`` (words left are joined by one space), and ``n_words`` and
    ``n_removed`` as columns."""
    prepared(docs)
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    glued = stored(
        repeated_paths(docs, k).groupBy("key")
        .agg(F.collect_list(F.struct("start", "edges")).alias("paths"))
    ).withColumnsRenamed({"key": "_rp_key", "paths": "_rp_paths"})
    keyed = docs.select(*[F.col(f"`{c}`") for c in names], text_key().alias("_rp_key"))
    both = keyed.join(glued, "_rp_key", "left").select(*[F.col(f"`{c}`") for c in names], "_rp_paths")
    plain = docs.select(*[F.col(f"`{c}`") for c in names]).withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long")})
    schema = StructType([StructField(f.name, f.dataType, True) for f in plain.schema.fields])
    return both.mapInArrow(_cover(k, schema.names, names.index("text"), len(names)), schema)
