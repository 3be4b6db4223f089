"""Best-fit packing of token sequences.

Documents become ids and pieces of at most ``LENGTH``
ids; only longer documents are cut. The tokenizer drops white space, folds case
and merges letters, digits and other characters apart, so words, and runs of
one kind in plain words, are encoded alone and once. Pieces, without their ids, are numbered and
dealt by a hash of the number (equal rows are spread like others) to tasks of
about ``TASK_PIECES`` pieces each, and each task packs its own
by bounded-space best fit: up to ``OPEN_BINS`` open bins, found through a bitset
keyed by free space (the lowest set bit at or above the piece's length is the
best fit); when there are too many, the fullest closes first. Pieces come
longest first. The number of tasks grows with the pieces, so a task's memory
and the share of half-empty last bins stay the same.

Cases: null or empty text is one piece with the end id alone; an empty table
gives an empty result; repeated rows are packed each; other columns are not
carried; null ids stay null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm import tokens
from tarmac.llm.bpe import id_bytes
from tarmac.llm.jobs import prepared, stored

LENGTH = 4096
END_ID = 1
OPEN_BINS = 1 << 14
TASK_PIECES = 50_000


def _tokenize(content, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.word_cache(content.value)
        for batch in batches:
            for t in tx.slices(batch.column(1)):
                data = tx.LOWER[t.data]  # as the tokenizer does
                start, end = tokens.plain_parts(data, *tx.bounds(data, t.offsets))
                ids, size = cache.lookup(data, start, end, tx.hash_spans(data, start, end))
                ends = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, t.offsets)[1:]]
                ids = np.insert(ids, ends, END_ID)
                ends = ends + np.arange(1, len(ends) + 1)
                total = np.diff(np.concatenate(([0], ends)))
                pieces = -(-total // length)
                row = np.repeat(np.arange(len(total)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * length
                bounds = np.append((ends - total)[row] + start, ends[-1] if len(ends) else 0)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(t.start, t.stop - t.start).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(np.diff(bounds)), id_bytes(ids, bounds),
                ], names=["doc_id", "piece", "start", "length", "ids"])

    return run


def pieces(docs: DataFrame, tokenizer_file: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids): ids as little-endian unsigned
    32-bit integers, the document's last one being the end id."""
    prepared(docs)
    with open(tokenizer_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select("doc_id", "text").mapInArrow(_tokenize(content, length), StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("piece", IntegerType()),
        StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType())]))


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, in the order given."""
    bins, offsets = [], []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
    bits = opened = 0
    made = 0
    for n in lengths:
        above = bits >> n
        if above:
            space = n + (above & -above).bit_length() - 1
            stack = free[space]
            b = stack.pop()
            if not stack:
                bits ^= 1 << space
        else:
            space, b = capacity, made
            made += 1
            opened += 1
        bins.append(b)
        offsets.append(capacity - space)
        space -= n
        if not space:
            opened -= 1
            continue
        if not free[space]:
            bits |= 1 << space
        free[space].append(b)
        if opened > open_bins:
            fullest = (bits & -bits).bit_length() - 1
            free[fullest].pop()
            if not free[fullest]:
                bits ^= 1 << fullest
            opened -= 1
    return bins, offsets


def _pack(capacity: int, open_bins: int, length_at: int, order_by: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        order = [(table.column_names[length_at], "descending"), *((table.column_names[i], "ascending") for i in order_by)]
        table = table.sort_by(order).drop_columns([table.column_names[-1]]).combine_chunks()
        bins, offsets = best_fit(table.column(length_at).to_pylist(), capacity, open_bins)
        first = TaskContext.get().partitionId() << 32
        out = [*table.columns, pa.array(bins, type=pa.int64()), pa.array(offsets, type=pa.int64())]
        out[-2] = pa.array(first + np.asarray(bins, dtype=np.int64))
        yield from pa.Table.from_arrays(out, names=names).to_batches(max_chunksize=10_000)

    return run


def packed(parts: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """``parts`` (with doc_id, piece and length) with ``sequence_id`` and
    ``offset``. The rows are written once before they are dealt out."""
    prepared(parts)
    rows = stored(parts.select(*[F.col(f"`{c}`") for c in parts.columns if c not in ("sequence_id", "offset")]))
    tasks = max(1, -(-rows.count() // TASK_PIECES))
    # stored rows keep their order, so a number stays the same when a task runs again
    dealt = rows.withColumn("_number", F.monotonically_increasing_id()).repartition(tasks, "_number")
    schema = StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields]
                        + [StructField("sequence_id", LongType()), StructField("offset", LongType())])
    order = [rows.columns.index("doc_id"), rows.columns.index("piece"), len(rows.columns)]
    return dealt.mapInArrow(_pack(length, open_bins, rows.columns.index("length"), order, schema.names), schema)
