from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    truth = marks.where(fold == 0).select("doc_id", F.col("toxic").alias("truth"))
    out = toxicity.scored(docs, marks.where(fold != 0)).join(truth, "doc_id")
    hit, missed, wrong, clean = out.agg(*[F.count_if(F.expr(e)) for e in (
        "truth = 1 and toxic", "truth = 1 and not toxic", "truth = 0 and toxic", "truth = 0 and not toxic")]).first()
    assert wrong <= 0.01 * (wrong + clean)
    assert hit >= 0.8 * (hit + missed)


def test_odd_texts_and_no_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.scored(odd_docs, none)
    assert out.where("toxic or severity > 0").count() == 0
    assert out.count() == odd_docs.count()
    assert toxicity.scored(no_docs, none).count() == 0


def test_clashing_names_are_replaced(spark, odd_docs):
    marks = spark.createDataFrame([(i, int(i in (7, 8, 9))) for i in range(20)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    out = toxicity.scored(odd_docs.withColumn("severity", F.lit("x")), marks)
    assert dict(out.dtypes)["severity"] == "double"
    assert out.count() == odd_docs.count()


def test_ordinal_fit_orders_thresholds_and_shares_weights():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, (4000, 3)).astype(float)
    z = x @ np.array([1.0, -0.5, 0.0]) + rng.logistic(size=4000)
    grade = (z > 1).astype(int) + (z > 3)
    row, index = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(row, index, x[row, index], grade, 3)
    assert cuts[0] < cuts[1]
    assert abs(w[0] - 1) < 0.2 and abs(w[1] + 0.5) < 0.2 and abs(w[2]) < 0.1
    assert abs(cuts[0] - 1) < 0.3 and abs(cuts[1] - 3) < 0.4


def _loss(z, cuts, grade):
    """-log P(grade), term by term, from the definition."""
    import math

    total = []
    for zi, g in zip(z, grade):
        reach = [1.0] + [1 / (1 + math.exp(c - zi)) for c in cuts] + [0.0]
        total.append(-math.log(reach[g] - reach[g + 1]))
    return np.array(total)


def test_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(4)
    z, grade, cuts = rng.standard_normal(40), rng.integers(0, 4, 40), np.array([-0.5, 0.3, 1.1])
    by_score, by_cut = toxicity.likelihood_slopes(z, cuts, grade)
    e = 1e-6
    assert np.allclose(by_score, (_loss(z + e, cuts, grade) - _loss(z - e, cuts, grade)) / (2 * e), atol=1e-5)
    for k in range(3):
        step = e * (np.arange(3) == k)
        assert np.allclose(by_cut[:, k], (_loss(z, cuts + step, grade) - _loss(z, cuts - step, grade)) / (2 * e), atol=1e-5)


def test_fit_like_a_brute_force_search():
    """The fitted likelihood is that of a plain coordinate search over all parameters."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 4, (150, 2)).astype(float)
    z = x @ np.array([0.9, -0.6]) + rng.logistic(size=150)
    grade = (z > 0.5).astype(int) + (z > 2)
    row, index = np.nonzero(x)
    w, cuts = toxicity.fit_ordinal(row, index, x[row, index], grade, 2)

    def loss(p):
        return _loss(x @ p[:2], p[2:], grade).mean() if p[3] > p[2] else np.inf

    best, step = np.array([0.0, 0.0, 0.0, 1.0]), 0.5
    while step > 1e-4:
        tries = [best + s * step * (np.arange(4) == k) for k in range(4) for s in (1, -1)]
        least = min(tries, key=loss)
        if loss(least) < loss(best) - 1e-12:
            best = least
        else:
            step /= 2
    assert abs(loss(np.concatenate((w, cuts))) - loss(best)) < 1e-3
    assert np.abs(np.concatenate((w, cuts)) - best).max() < 0.05


def test_one_row_for_each_sampled_id(spark):
    from tarmac.llm import samples

    docs = spark.createDataFrame([(1, "a b"), *[(2, f"copy {i % 3}") for i in range(500)], (3, None), (3, None), (4, "d")], "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, 1), (9, 1)], "doc_id long, toxic int")
    got = samples.labelled(docs, marks, "toxic").collect()
    assert sorted((r.doc_id, r.y) for r in got) == [(1, 0), (2, 1), (3, 1)]
    assert samples.labelled(docs, marks, "toxic", 2).count() <= 2
