from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import repeats
from tarmac.llm import text as tx

from .plain import without_repeats


def rewritten(df, k=repeats.K):
    out = repeats.remove_repeats(df, k).select("doc_id", "n_words", "n_removed", "text").collect()
    return sorted(tuple(r) for r in out if r[0] is not None), sum(r[0] is None for r in out)


def test_odd_texts_like_brute_force(odd_docs, odd_texts):
    want = without_repeats([t for _, t in odd_texts], repeats.K)
    got, nulls = rewritten(odd_docs)
    assert got == sorted((i, *w) for (i, _), w in zip(odd_texts, want) if i is not None)
    assert nulls == 2
    assert repeats.remove_repeats(odd_docs).columns == ["doc_id", "text", "kept", "n_words", "n_removed"]


def test_empty_table(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("k", [16, 20, 35])
def test_random_texts_like_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(repeats, "FLUSH_WINDOWS", 300)
    monkeypatch.setattr(tx, "SLICE_BYTES", 2000)
    rng = random.Random(k)
    pool = [[rng.choice("abcdefgh") for _ in range(rng.randrange(10, 90))] for _ in range(12)]
    texts = [" ".join(w for _ in range(rng.randrange(0, 5)) for w in rng.choice(pool)[rng.randrange(3):]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = without_repeats(texts, k)
    assert rewritten(df, k)[0] == [(i, *w) for i, w in enumerate(want)]
    assert sum(w[1] for w in want) > 0


def test_k_has_a_lower_bound(odd_docs):
    with pytest.raises(ValueError):
        repeats.remove_repeats(odd_docs, 5)


def test_minimizers_are_shared_by_equal_windows():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 3, 5000).astype(np.uint64)  # many ties
    hashes = tx.mix(words)
    place, anchor = repeats.minimizers(hashes, 20, 16)
    seen = {}
    for i in range(len(place)):
        key = words[i : i + 20].tobytes()
        assert seen.setdefault(key, (place[i] - i, anchor[i])) == (place[i] - i, anchor[i])
        assert 0 <= place[i] - i <= 4


def test_passage_in_a_third_of_all_documents(spark):
    shared = " ".join(f"s{i}" for i in range(52))
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat_ws(
        " ", F.concat(F.lit("a"), "id"), F.lit(shared), F.concat(F.lit("b"), "id"))).otherwise(F.concat(F.lit("c"), "id")).alias("text"))
    out = repeats.remove_repeats(df)
    assert out.where("n_removed = 52").count() == 200
    assert {r.text for r in out.where("doc_id = 3").collect()} == {"a3 b3"}
