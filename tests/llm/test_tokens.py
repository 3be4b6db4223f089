from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tarmac.llm import bpe, packing, tokens

vocabularies = pytest.importorskip("public_tokenizers")
RANKS = vocabularies.path("byte_bpe_multi_50k.tiktoken")
WORDS = vocabularies.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("plain", pat_str=vocabularies.PATTERN, mergeable_ranks=tokens.ranks_of(f.read()), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


MORE = ["a b　\n\n c", "x" * 3000 + " 's'll 12ab   y", "\t\n \r\n don't  stop é ́ Å", "   \n\n\n", " ",
        "tail   ", "a" + "　" * 40_000 + " b" + "\n" * 30_000, "1" * 2000, "ça ÇA Été × ÷ \x07bell \x1f unit"]


@pytest.fixture(scope="module")
def docs(spark, odd_texts):
    rows = odd_texts + [(1000 + i, t) for i, t in enumerate(MORE)]
    return rows, spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "doc_id long, text string, n_tokens string, ids binary").repartition(3)


def test_bpe_like_the_library_and_back(docs, encoding):
    rows, df = docs
    out = bpe.decoded(bpe.encoded(df, RANKS, vocabularies.PATTERN), RANKS)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    got = sorted((r.doc_id or 0, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), bytes(r.decoded)) for r in out.collect())
    want = []
    for i, t in rows:
        ids = encoding.encode_ordinary(t or "")
        want.append((i or 0, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), (t or "").encode()))
    assert got == sorted(want)
    both = bpe.round_trip(df, RANKS, vocabularies.PATTERN)
    assert both.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert sorted((r.doc_id or 0, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), bytes(r.decoded)) for r in both.collect()) == sorted(want)


def test_white_space_beyond_the_librarys_stack(spark, encoding):
    text = "a" + " " * 1_200_000 + "b"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = bpe.decoded(bpe.encoded(df, RANKS, vocabularies.PATTERN), RANKS).first()
    assert bytes(r.decoded) == text.encode()
    short = "a" + " " * 50_000 + "b"
    df = spark.createDataFrame([(1, short)], "doc_id long, text string")
    ids = np.frombuffer(bpe.encoded(df, RANKS, vocabularies.PATTERN).first().ids, dtype="<u4")
    assert ids.tolist() == encoding.encode_ordinary(short)


def test_empty_table(no_docs):
    assert bpe.decoded(bpe.encoded(no_docs, RANKS, vocabularies.PATTERN), RANKS).count() == 0
    assert bpe.round_trip(no_docs, RANKS, vocabularies.PATTERN).count() == 0
    assert packing.packed(packing.pieces(no_docs, WORDS)).count() == 0


def test_pieces_like_the_library(docs, tokenizer):
    rows, df = docs
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i or 0, n, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], dtype="<u4").tobytes()))
                 for n, a in enumerate(range(0, len(ids), 4096))]
    got = [(r.doc_id or 0, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in packing.pieces(df, WORDS).collect()]
    assert sorted(got) == sorted(want)


def test_packing_has_no_gaps_and_wastes_little(spark, docs):
    _, df = docs
    more = spark.range(3000).selectExpr("id + 5000 as doc_id", "repeat('word ', cast(pmod(id * 7919, 2500) as int)) as text")
    parts = packing.pieces(df.select("doc_id", "text").unionByName(more), WORDS).drop("ids")
    placed = packing.packed(parts).collect()
    assert len(placed) == parts.count()
    by = defaultdict(list)
    for r in placed:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= 1.01 * sum(r.length for r in placed) / 4096 + 1


def test_best_fit_with_few_open_bins_closes_the_fullest():
    bins, offsets = packing.best_fit([60, 70, 50, 40, 30], 100, 2)
    # 50 opens a third bin, so the bin with 70 closes and 30 must go elsewhere
    assert bins == [0, 1, 2, 0, 2]
    assert offsets == [0, 0, 0, 60, 50]


def test_equal_rows_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_PIECES", 100)
    rows = [(7, 0, 0, 40)] * 400 + [(i, 0, 0, 1 + i % 90) for i in range(1000, 1800)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long").repartition(3)
    got = packing.packed(df, 256).collect()
    assert len(got) == len(rows)
    tasks = defaultdict(int)
    for r in got:
        tasks[r.sequence_id >> 32] += 1
    assert len(tasks) >= 10 and max(tasks.values()) < 170
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
