from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import residues

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, anchor string"


def brute(rows, n_pos=5, n_neg=5):
    """(anchor, positive, rank, negative, scores) over all pairs, in Python integers."""
    live = []
    for at, (i, label, v) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 2**59:
            live.append((at, i, label, q))
    by = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for at, i, label, q in live:
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(q, r)), j, k == label) for b, j, k, r in live if b != at and len(r) == len(q)]
        for score, p, _ in sorted((s for s in scored if s[2]), key=by)[:n_pos]:
            window = sorted((s for s in scored if not s[2] and 80 * score <= 100 * s[0] <= 100 * score), key=by)
            out += [(i, p, rank, s[1], score, s[0]) for rank, s in enumerate(window[:n_neg], 1)]
    return sorted(out, key=str)


def result(df, **more):
    got = residues.hard_negatives(df, F.col("vec_id") % 100 == 0, **more).collect()
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got), key=str)


@pytest.mark.parametrize("scale", [1, 300, 2**29])
@pytest.mark.parametrize("dim", [0, 1, 63, 200])
def test_products_are_exact(scale, dim):
    rng = np.random.default_rng([scale, dim])
    size = max(1, min(scale, math.isqrt(2**59 // max(dim, 1)) - 1))
    a, b = rng.integers(-size, size + 1, (7, dim)), rng.integers(-size, size + 1, (9, dim))
    if dim:
        a[0], b[0], b[1] = size, size, -size
    primes = residues.primes_for(max(1, dim * size * size))
    got = residues.products(residues.residue_planes(a, primes), residues.residue_planes(b, primes), primes)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert got.dtype == np.int64


def test_primes_cover_signed_bound():
    assert residues.primes_for(510) == (1021,)
    assert residues.primes_for(511) == (1021, 1019)
    assert len(residues.primes_for(2**59)) <= len(residues.PRIMES)
    with pytest.raises(ValueError):
        residues.primes_for(2**80)


@pytest.mark.parametrize("blocks", [(3, 7), (2048, 2048)])
def test_like_brute_force(spark, blocks):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((4, 6))
    rows = [(i if i % 41 else None, int(rng.integers(3)) if i % 29 else None, (centre[rng.integers(4)] + 0.3 * rng.standard_normal(6)).tolist())
            for i in range(50, 420)]
    rows += [(500, 1, rows[3][2]), (501, 1, rows[3][2]), (502, 2, rows[3][2]), (503, 0, rows[3][2])]  # equal scores
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert result(df, anchor_block=blocks[0], row_block=blocks[1]) == brute(rows) != []


def test_odd_rows(spark):
    a = [1.0, 2.0, -1.5]
    rows = [(100, 1, a), (100, 1, a), (1, 1, a), (2, 2, a), (2, 2, a), (3, None, a), (4, 2, None), (5, 2, [1.0, None, 1.0]),
            (6, 2, [1.0, float("nan"), 1.0]), (7, 2, [float("inf"), 0.0, 0.0]), (8, 2, [1e30, 0.0, 0.0]), (9, 2, [1.0, 2.0]), (10, 1, [1.0, 2.0]),
            (200, 1, []), (201, 1, []), (202, 2, []), (300, 3, [0.0, 0.0, 0.0]), (None, 3, [0.001, 0.0, 0.0]), (None, 4, [0.0, 0.0, 0.0]),
            (400, 5, [-1.0, -2.0, 1.5]), (401, 5, a), (500, 6, [1e6, -1e6, 1e6]), (501, 6, [1e6, -1e6, 1e6]), (502, 7, [1e6, -9e5, 1e6])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = result(df)
    assert got == brute(rows)
    assert {r[0] for r in got} >= {100, 200, 300, 500}


def test_no_rows_and_no_anchors(spark):
    assert residues.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(1, 1, [1.0], "x", "y")], SCHEMA)
    none = residues.hard_negatives(one, F.col("vec_id") % 100 == 0)
    some = residues.hard_negatives(one, F.col("vec_id") == 1)
    assert none.count() == some.count() == 0
    assert none.dtypes == some.dtypes


def test_a_third_of_all_rows_equal(spark):
    rows = [(i, i % 3, [1.0, float(i % 5), 2.0] if i % 3 else [3.0, 1.0, 2.0]) for i in range(1, 301)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    assert result(df, anchor_block=2, row_block=16) == brute(rows)
