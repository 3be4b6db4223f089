"""Byte-level BPE by a local rank file, as the tiktoken library encodes.

Texts are pre-split at *safe boundaries*: before an ASCII white-space character
that follows a character that is no white space. No match of the pattern
reaches over such a place (a match is white space only, or one optional space
and then none), and no look-ahead there sees anything but the same two
characters, so parts can be encoded alone, however long the text is. Distinct
parts of a slice are encoded once. Decoding joins the raw bytes of the ids.

Each direction, and both together (:func:`round_trip`), is one pass over the
rows without a shuffle.

Cases: null and empty text give no ids and decode to no bytes; an empty table
gives an empty result; repeated rows are encoded alike; other columns pass
through, except those named like the outputs, which are replaced. Bytes that
are not UTF-8 are replaced as Python's decoder does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm import tokens
from tarmac.llm.jobs import prepared

_WIDE_SPACES = [c.encode() for c in tokens.WHITE_SPACE if c > "\x7f"]


def _after_wide_space(data: np.ndarray) -> np.ndarray:
    """Positions just behind a white-space character beyond ASCII."""
    out = [np.zeros(0, dtype=np.int64)]
    for lead in {s[0] for s in _WIDE_SPACES}:
        at = np.flatnonzero(data == lead)
        for s in _WIDE_SPACES:
            if s[0] == lead and len(at):
                here = at[at + len(s) <= len(data)]
                for i, b in enumerate(s[1:], 1):
                    here = here[data[here + i] == b]
                out.append(here + len(s))
    return np.concatenate(out)


def safe_parts(t: tx.Texts) -> np.ndarray:
    """Starts of the parts, in order; every row's start with a byte is one."""
    space = tx.SPACE[t.data]
    cut = np.zeros(len(t.data) + 1, dtype=bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    cut[_after_wide_space(t.data)] = False
    cut[t.offsets] = True
    cut[-1] = False
    return np.flatnonzero(cut)


def encode_rows(t: tx.Texts, cache: tokens.PartCache) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the bounds of each row's."""
    start = safe_parts(t)
    end = np.append(start[1:], len(t.data))[: len(start)]
    ids, size = cache.lookup(t.data, start, end, tx.hash_spans(t.data, start, end))
    total = np.concatenate(([0], np.cumsum(size)))
    return ids, total[np.searchsorted(start, t.offsets)]


def id_bytes(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each row's ids as little-endian unsigned 32-bit integers."""
    body = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(body)])


def _encode(ranks, pattern: str, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.rank_cache(ranks.value, pattern)
        for batch in batches:
            for t in tx.slices(batch.column(text_at)):
                ids, bounds = encode_rows(t, cache)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(t.start, t.stop - t.start) for i in range(batch.num_columns)]
                    + [pa.array(np.diff(bounds)), id_bytes(ids, bounds)], names=names)

    return run


def decode_rows(ids: np.ndarray, bounds: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """The raw bytes of each row's ids."""
    body, off = table
    ids = ids.astype(np.int64)
    size = off[ids + 1] - off[ids]
    total = np.concatenate(([0], np.cumsum(size)))[bounds]
    raw = body[tx.ragged(off[ids], size)]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(total.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


def _decode(ranks, ids_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tokens.byte_table(ranks.value)
        for batch in batches:
            for t in tx.slices(batch.column(ids_at)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(t.start, t.stop - t.start) for i in range(batch.num_columns)]
                    + [decode_rows(np.ascontiguousarray(t.data).view("<u4"), t.offsets // 4, table)], names=names)

    return run


def _both_ways(ranks, pattern: str, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.rank_cache(ranks.value, pattern)
        table = tokens.byte_table(ranks.value)
        for batch in batches:
            for t in tx.slices(batch.column(text_at)):
                ids, bounds = encode_rows(t, cache)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(t.start, t.stop - t.start) for i in range(batch.num_columns) if i != text_at]
                    + [pa.array(np.diff(bounds)), id_bytes(ids, bounds), decode_rows(ids, bounds, table)], names=names)

    return run


def _with(df: DataFrame, run, column: str, *fields: StructField) -> DataFrame:
    keep = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in fields}])
    schema = StructType([StructField(f.name, f.dataType, True) for f in keep.schema.fields] + list(fields))
    return keep.mapInArrow(run(keep.columns.index(column), schema.names), schema)


def _content(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    prepared(docs)
    ranks = _content(docs, rank_file)
    return _with(docs, lambda at, names: _encode(ranks, pattern, at, names), "text",
                 StructField("n_tokens", LongType()), StructField("ids", BinaryType()))


def decoded(df: DataFrame, rank_file: str) -> DataFrame:
    """``df`` with ``decoded``, the raw bytes of its ``ids``."""
    ranks = _content(df, rank_file)
    return _with(df, lambda at, names: _decode(ranks, at, names), "ids", StructField("decoded", BinaryType()))


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``ids`` and ``decoded``: both
    directions in one pass, so a task has one Python worker and neither texts
    nor ids go there and back between two."""
    prepared(docs)
    ranks = _content(docs, rank_file)
    made = [StructField("n_tokens", LongType()), StructField("ids", BinaryType()), StructField("decoded", BinaryType())]
    keep = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in {f.name for f in made}])
    schema = StructType([StructField(f.name, f.dataType, True) for f in keep.schema.fields if f.name != "text"] + made)
    return keep.mapInArrow(_both_ways(ranks, pattern, keep.columns.index("text"), schema.names), schema)
