"""First-fit decreasing packing with a tournament tree, in random groups of
documents.

Documents become ids and pieces: full ones of ``LENGTH`` ids and a remainder.
A row for each document holds the checksums of its pieces and, for the
remainder, those of its *binary parts* (one for each bit set in its length,
longest first), so no ids are moved. Documents are numbered and dealt by a hash
of that number to groups of about ``GROUP_DOCS``, whatever they hold, so equal
rows are spread like others. Each group is packed alone: remainders, longest
first, go to the first bin with room, which is found by walking down a
tournament tree of the bins' free space.

A bin that is left with more than ``WASTE`` free places, and whose fill is no
power of two, is dissolved: its remainders are cut into their binary parts, which
fill bins exactly when taken longest first; what is left over becomes sequences
whose lengths are powers of two. So whatever the lengths are, at most ``WASTE``
of ``LENGTH`` places are padding, and only documents of badly filled bins are cut
without need.

Cases: null or empty text is one piece with the end id alone; an empty table
gives an empty result; repeated rows are packed each; ties in length are taken in
the order of the documents' numbers; other columns are not read; null ids stay
null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm import tokens
from tarmac.llm.jobs import prepared, stored

LENGTH = 2048
END_ID = 1
GROUP_DOCS = 20_000
WASTE = 16


def binary_parts(n: int) -> list[int]:
    """The powers of two that make up n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cut(tokens_in: int, length: int) -> list[int]:
    """Lengths of a document's pieces, then those of its remainder's parts."""
    rest = tokens_in % length
    return [length] * (tokens_in // length) + ([rest] + binary_parts(rest) if rest else [])


def _checksums(ids: memoryview, length: int) -> bytes:
    """CRC-32 of each of :func:`cut`'s pieces and parts, four bytes each."""
    n = len(ids) // 4
    full = n - n % length
    at = [(a, a + length) for a in range(0, full, length)]
    if n > full:
        at.append((full, n))
        for size in binary_parts(n - full):
            at.append((full, full + size))
            full += size
    return np.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in at], dtype="<u4").tobytes()


def _measure(content, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.word_cache(content.value)
        for batch in batches:
            for t in tx.slices(batch.column(1)):
                data = tx.LOWER[t.data]  # as the tokenizer does
                start, end = tokens.plain_parts(data, *tx.bounds(data, t.offsets))
                ids, size = cache.lookup(data, start, end, tx.hash_spans(data, start, end))
                ends = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, t.offsets)[1:]]
                raw = memoryview(np.insert(ids, ends, END_ID).astype("<u4")).cast("B")
                at = np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))
                sums = [_checksums(raw[4 * a : 4 * b], length) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.start, t.stop - t.start), pa.array(np.diff(at)), pa.array(sums, type=pa.binary())],
                    names=["doc_id", "doc_tokens", "sums"])

    return run


class FreeSpace:
    """A tournament tree: every node holds the larger free space of its two
    children, every leaf that of a bin. Grows when all bins are in use."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.leaves = 1
        self.best = [0, capacity]

    def _grow(self) -> None:
        n = self.leaves
        leaves = self.best[n:] + [self.capacity] * n
        self.leaves = 2 * n
        self.best = [0] * self.leaves + leaves
        for node in range(self.leaves - 1, 0, -1):
            self.best[node] = max(self.best[2 * node], self.best[2 * node + 1])

    def place(self, n: int) -> tuple[int, int]:
        """The first bin with room for n, and the offset there."""
        if self.best[1] < n:
            self._grow()
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < n:
                node += 1
        bin_, free = node - self.leaves, best[node]
        best[node] = free - n
        while node > 1:
            node //= 2
            most = max(best[2 * node], best[2 * node + 1])
            if best[node] == most:
                break
            best[node] = most
        return bin_, self.capacity - free


def _binary_sequences(parts: list[tuple[int, int]], capacity: int) -> list[list[tuple[int, int]]]:
    """Sequences of ``parts`` (length, name), whose lengths are powers of two:
    full ones, then one for each bit of what is left."""
    parts = sorted(parts, key=lambda p: (-p[0], p[1]))
    total = sum(n for n, _ in parts)
    sizes = [capacity] * (total // capacity) + binary_parts(total % capacity)
    out: list[list[tuple[int, int]]] = []
    rest = 0
    for part in parts:
        if not rest:
            rest = sizes[len(out)]
            out.append([])
        out[-1].append(part)
        rest -= part[0]
    return out


def first_fit(lengths: list[int], capacity: int, waste: int = WASTE) -> list[tuple[int, int, int, int]]:
    """Places (item, part, bin, offset) of ``lengths``, each at most
    ``capacity`` (a power of two). Part -1 is the whole item, others are its binary parts."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    tree = FreeSpace(capacity)
    where = [(0, 0)] * len(lengths)
    filled: dict[int, int] = {}
    for i in order:
        b, offset = where[i] = tree.place(lengths[i])
        filled[b] = offset + lengths[i]
    poor = {b for b, n in filled.items() if capacity - n > waste and n & (n - 1)}
    out = [(i, -1, b, offset) for i, (b, offset) in enumerate(where) if b not in poor]
    sizes = {i: binary_parts(lengths[i]) for i, (b, _) in enumerate(where) if b in poor}
    names = [(i, k) for i in sizes for k in range(len(sizes[i]))]
    for b, sequence in enumerate(_binary_sequences([(sizes[i][k], at) for at, (i, k) in enumerate(names)], capacity), len(filled)):
        offset = 0
        for n, at in sequence:
            out.append((*names[at], b, offset))
            offset += n
    return out


def _pack(length: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("number").combine_chunks()
        total = table.column("doc_tokens").to_numpy()
        raw = table.column("sums").combine_chunks()
        sums, offsets = tx.byte_view(raw)
        sums, first = np.ascontiguousarray(sums).view("<u4").astype(np.int64), offsets[:-1] // 4
        whole = total // length
        base = TaskContext.get().partitionId() << 32

        # full pieces are sequences of their own
        doc = np.repeat(np.arange(len(total)), whole)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
        columns = [(doc, nth * length, np.full(len(doc), length), sums[first[doc] + nth], base + np.arange(len(doc)), np.zeros(len(doc), dtype=np.int64))]

        rest = total % length
        own = np.flatnonzero(rest)
        at = np.array(first_fit(rest[own].tolist(), length), dtype=np.int64).reshape(-1, 4)
        doc, part = own[at[:, 0]], at[:, 1]
        start, size = whole[doc] * length, rest[doc]
        for row in np.flatnonzero(part >= 0).tolist():
            parts = binary_parts(int(size[row]))
            start[row] += sum(parts[: part[row]])
            size[row] = parts[part[row]]
        columns.append((doc, start, size, sums[first[doc] + whole[doc] + 1 + part], base + len(columns[0][0]) + at[:, 2], at[:, 3]))

        doc, start, size, crc, sequence, offset = (np.concatenate(c) for c in zip(*columns))
        ids = table.column("doc_id").combine_chunks()
        out = [ids.take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(crc), pa.array(total[doc]), pa.array(sequence), pa.array(offset)]
        yield from pa.Table.from_arrays(out, names=names).to_batches(max_chunksize=10_000)

    return run


def packed(docs: DataFrame, tokenizer_file: str, length: int = LENGTH, group_docs: int = GROUP_DOCS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the
    spans of ids of all documents, each in its place. ``length`` is a power of two."""
    if length < 1 or length & (length - 1):
        raise ValueError(f"length {length} is no power of two")
    prepared(docs)
    with open(tokenizer_file, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType
    measured = stored(docs.select("doc_id", "text").mapInArrow(_measure(content, length), StructType([
        StructField("doc_id", kind), StructField("doc_tokens", LongType()), StructField("sums", BinaryType())])))
    groups = max(1, -(-measured.count() // group_docs))
    # stored rows keep their order, so a number stays the same when a task runs again
    dealt = measured.withColumn("number", F.monotonically_increasing_id()).repartition(groups, "number")
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return dealt.mapInArrow(_pack(length), StructType(
        [StructField("doc_id", kind)] + [StructField(n, LongType()) for n in longs]))
