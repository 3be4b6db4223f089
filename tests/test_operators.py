"""Operators against brute force on small random inputs."""

from __future__ import annotations

import itertools
import random

import pytest

from tarmac.operators import dense_index, extreme_rows, missing_pairs, unreached_from


@pytest.mark.parametrize("n", [1, 7, 40, 300])
def test_dense_index_is_dense_and_ordered(spark, n):
    rnd = random.Random(n)
    words = [f"w{rnd.randrange(10 ** 6):06d}" for _ in range(n)]
    rows = [(w,) for w in words + words[: n // 2]] + [(None,)]
    df = spark.createDataFrame(rows, "w string").repartition(5)
    got = {r["w"]: r["i"] for r in dense_index(df, "w", "i").collect()}
    expected = {w: i for i, w in enumerate(sorted(set(words)))}
    assert got == expected


def _brute_missing(nodes, edges):
    names = sorted({n for n in nodes if n is not None})
    linked = set(edges)
    return sorted((a, b) for a, b in itertools.combinations(names, 2) if (a, b) not in linked)


@pytest.mark.parametrize("seed", range(6))
def test_missing_pairs_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = rnd.choice([1, 2, 5, 12, 30])
    names = [f"city{i:02d}" for i in range(n)] + ["Москва", "Санкт-Петербург"][: seed % 3]
    nodes = [rnd.choice(names) for _ in range(len(names) * 2)] + names + [None]
    density = rnd.random()
    edges = [(a, b) for a in names + ["ghost"] for b in names + ["ghost"]
             if a != b and rnd.random() < density]
    edges += edges[: len(edges) // 3]  # duplicates
    nd = spark.createDataFrame([(x,) for x in nodes], "city string")
    ed = spark.createDataFrame(edges or [("x", "y")], "src string, dst string")
    if not edges:
        ed = ed.where("false")
    got = sorted(tuple(r) for r in missing_pairs(nd, "city", ed, "src", "dst", "c1", "c2").collect())
    assert got == _brute_missing(nodes, edges)


def test_unreached_from(spark):
    nd = spark.createDataFrame([("A",), ("B",), ("C",), ("C",), (None,)], "city string")
    ed = spark.createDataFrame([("A", "B"), ("B", "C"), ("A", "A")], "src string, dst string")
    got = sorted(r[0] for r in unreached_from(nd, "city", ed, "src", "dst", "A", "x").collect())
    assert got == ["C"]
    assert unreached_from(nd, "city", ed, "src", "dst", "Q", "x").count() == 0


def test_extreme_rows_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", None)], "k string, v int")
    assert sorted(r["k"] for r in extreme_rows(df, "v").collect()) == ["b", "c"]
    assert sorted(r["k"] for r in extreme_rows(df, "v", largest=False).collect()) == ["a"]
    only_null = spark.createDataFrame([("d", None)], "k string, v int")
    assert extreme_rows(only_null, "v").count() == 0


def test_missing_pairs_empty_and_single_node(spark):
    nd = spark.createDataFrame([], "city string")
    ed = spark.createDataFrame([("A", "B")], "src string, dst string")
    assert missing_pairs(nd, "city", ed, "src", "dst", "c1", "c2").count() == 0
    one = spark.createDataFrame([("A",), ("A",)], "city string")
    assert missing_pairs(one, "city", ed, "src", "dst", "c1", "c2").count() == 0
    assert dense_index(nd, "city", "i").count() == 0
