from __future__ import annotations

import collections
import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarmac.llm import decreasing

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def checked(rows, texts, ids, length, waste=decreasing.WASTE):
    """Every id in one piece, sequences without gaps; returns the padding."""
    of = collections.defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    want = collections.defaultdict(collections.Counter)
    for i, t in texts:
        want[i][tuple(ids(t))] += 1
    for i, documents in want.items():
        assert {r.doc_tokens for r in of[i]} == {len(d) for d in documents}
        assert sum(r.length for r in of[i]) == sum(len(d) * n for d, n in documents.items())
        places = collections.Counter()
        for r in of[i]:
            assert 0 < r.length <= length
            sums = {zlib.crc32(struct.pack(f"<{r.length}I", *d[r.start : r.start + r.length])) for d in documents if len(d) == r.doc_tokens}
            assert r.ids_crc32 in sums
            places.update((r.doc_tokens, k) for k in range(r.start, r.start + r.length))
        copies = collections.Counter()
        for d, n in documents.items():
            copies.update({(len(d), k): n for k in range(len(d))})
        assert places == copies
    padding = 0
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        if at & (at - 1):
            assert length - at <= waste
            padding += length - at
    return padding, len(sequences)


@pytest.mark.parametrize("group,length", [(4, 64), (20_000, 2048)])
def test_odd_texts(odd_docs, odd_texts, ids, group, length):
    rows = decreasing.packed(odd_docs, FILE, length, group).collect()
    checked(rows, odd_texts, ids, length)
    assert set(rows[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_empty_table(no_docs):
    assert decreasing.packed(no_docs, FILE).count() == 0


def test_lengths_that_fit_badly(spark, ids):
    """Documents of a little over half a sequence: whole ones would waste almost half."""
    texts = [(i, " ".join(["a"] * (1100 + i % 7))) for i in range(40)]
    rows = decreasing.packed(spark.createDataFrame(texts, "doc_id long, text string"), FILE).collect()
    padding, _ = checked(rows, texts, ids, 2048)
    assert padding == 0


def test_a_third_of_all_rows_equal(spark, ids):
    texts = [(7, "one and the same text")] * 300 + [(i, " ".join(["b"] * (i % 90))) for i in range(100, 700)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    out = decreasing.packed(df, FILE, 256, 50)
    rows = out.collect()
    checked(rows, texts, ids, 256)
    groups = collections.Counter(r.sequence_id >> 32 for r in rows)
    assert len(groups) >= 12 and max(groups.values()) < 130


def plain_first_fit(lengths, capacity):
    bins, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, free in enumerate(bins) if free >= lengths[i]), len(bins))
        bins += [capacity] * (b == len(bins))
        out.append((i, -1, b, capacity - bins[b]))
        bins[b] -= lengths[i]
    return sorted(out)


def test_tree_places_as_plain_first_fit_decreasing():
    rng = random.Random(5)
    for n in (0, 1, 2, 17, 300):
        lengths = [rng.randint(1, 64) for _ in range(n)]
        assert sorted(decreasing.first_fit(lengths, 64, waste=64)) == plain_first_fit(lengths, 64)


def test_binary_parts():
    assert decreasing.binary_parts(1) == [1]
    assert decreasing.binary_parts(1100) == [1024, 64, 8, 4]
    assert decreasing.cut(4100, 2048) == [2048, 2048, 4, 4]
    assert decreasing.cut(2048, 2048) == [2048]


def test_length_must_be_a_power_of_two(no_docs):
    with pytest.raises(ValueError):
        decreasing.packed(no_docs, FILE, 100)
