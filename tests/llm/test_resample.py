from __future__ import annotations

import collections
import math
import re

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import resample
from tarmac.llm import text as tx

from .plain import ascii_lower, words


def test_top_k_of_the_keys(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = resample.resampled(docs, labels, share=0.5).toPandas()
    assert len(out) == docs.count()
    assert out["kept"].sum() == round(0.5 * len(out))
    assert sorted(out["rank"]) == list(range(1, len(out) + 1))
    assert out[out["kept"]]["gumbel_key"].min() >= out[~out["kept"]]["gumbel_key"].max()
    noise = out["gumbel_key"] - out["log_weight"]
    assert abs(noise.mean() - 0.5772) < 0.15 and abs(noise.std() - 1.2825) < 0.15
    again = resample.resampled(docs, labels, share=0.5).toPandas()
    assert set(out[out["kept"]]["doc_id"]) == set(again[again["kept"]]["doc_id"])


def test_weights_like_brute_force(spark):
    docs = spark.createDataFrame([(1, "a b, a"), (2, "c"), (3, "a b"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    ratios = resample.log_ratios(docs, labels)
    seen = np.exp(ratios)
    assert np.isfinite(ratios).all()
    got = {r.doc_id: r.log_weight for r in resample.resampled(docs, labels, share=1.0).collect()}
    assert got[1] > got[3] > 0 > got[2] and got[4] == 0
    assert seen.max() > 1 > seen.min()


def test_good_documents_are_preferred_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    out = resample.resampled(docs, labels.where(fold != 0)).join(labels.where(fold == 0), "doc_id")
    good, bad = (out.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.95 and bad < 0.2


def test_odd_texts_and_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = resample.resampled(odd_docs, none).collect()
    assert len(out) == odd_docs.count() and all(r.kept for r in out)
    assert resample.resampled(no_docs, none).count() == 0


M = 1 << 64


def _mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % M
    return x ^ (x >> 31)


def _polynomial(values, base):
    return _mix(sum(v * pow(base, i, M) for i, v in enumerate(values)) % M)


def _plain_grams(text):
    """Buckets of a text's unigrams and bigrams, in Python integers."""
    parts = [p for w in words(ascii_lower(text or "")) for p in re.findall(r"[0-9A-Za-z'\u0080-\U0010ffff]+|[^0-9A-Za-z'\u0080-\U0010ffff]+", w)]
    h = [_polynomial([b + 1 for b in p.encode()], tx.BYTE_BASE) for p in parts]
    two = [_polynomial(pair, tx.WORD_BASE) for pair in zip(h, h[1:])]
    return [(x >> 32) * resample.BUCKETS >> 32 for x in h + two]


def test_weights_equal_a_plain_model(spark, odd_docs, odd_texts):
    """log(target / raw), summed over n-grams, from counts made one by one."""
    good = {7, 8, 12, 16, 17}
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(1, 20)], "doc_id long, quality int")
    short = [(i, t) for i, t in odd_texts if len(t or "") < 60_000]
    docs = odd_docs.where(F.coalesce(F.length("text"), F.lit(0)) < 60_000)
    grams = [(i, _plain_grams(t)) for i, t in short]
    raw, target = collections.Counter(), collections.Counter()
    for i, g in grams:
        raw.update(g)
        if i in good:
            target.update(g)
    n_raw, n_target = sum(raw.values()) + resample.BUCKETS, sum(target.values())
    prior = resample.PRIOR
    ratio = {b: math.log((target[b] + prior * (raw[b] + 1) / n_raw) / (n_target + prior) / ((raw[b] + 1) / n_raw)) for b in raw}
    want = sorted((i is None, i or 0, len(g), sum(ratio[b] for b in g)) for i, g in grams)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_grams, r.log_weight) for r in resample.resampled(docs, labels, share=1.0).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert abs(g[3] - w[3]) <= 1e-6 * (1 + abs(w[3])), w[:3]
