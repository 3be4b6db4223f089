"""The pipeline on a small made corpus against what a reader would do by hand."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline

from .plain import groups, near_links, shingles, without_repeats


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows, marks = [], []
    shared = " ".join(f"p{rng.randrange(500)}" for _ in range(60))
    for i in range(240):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(70, 200))]
        toxic, bad = i % 8 == 0, i % 8 == 1
        if toxic:
            for k in range(0, len(w), 12):
                w[k] = "vile" if k % 24 else "nasty"
        text = " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w)
        if i % 8 == 2:
            text += "\n" + shared
        rows.append((i, text))
        marks.append((i, int(not bad), int(toxic)))
        if i % 8 == 3:
            w[len(w) // 2] = "changed"
            rows.append((1000 + i, " ".join(w)))
    rows += [(2000, None), (2001, ""), (rows[4][0], rows[4][1])]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_stages_like_a_plain_version(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left
        if name == "toxicity":
            left = [r for r in left if r[0] >= 1000 or r[0] % 8 != 0]
        elif name == "quality_rules":
            left = [r for r in left if len((r[1] or "").split()) >= 50 and "!!" not in r[1]]
        elif name == "near_dedup":
            root = groups(len(left), near_links([shingles(t) for _, t in left]))
            least = {}
            for (i, _), r in zip(left, root):
                least[r] = min(i, least.get(r, i))
            left = list({r[0]: r for r, g in zip(left, root) if r[0] == least[g]}.values())
        else:
            left = [(i, x[2]) for (i, _), x in zip(left, without_repeats([t for _, t in left], 35))]
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        path = f"{folder}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        order = lambda r: (r[0], r[1] or "")
        got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=order)
        assert got == sorted(left, key=order), name
        assert len(left) < len(before) or name == "substring_dedup"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in left}


def test_run_reads_every_stage(spark, corpus):
    folder, _ = corpus
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(out.columns)
    assert out.count() > 100


def test_empty_documents(spark, corpus, tmp_path):
    folder, _ = corpus
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_names_nulls_ties_and_repeated_rows(spark, corpus, tmp_path):
    """User columns named like outputs come through every stage as they were."""
    folder, rows = corpus
    clash = ["toxic", "grade", "severity", "p_toxic", "n_words", "kept", "base_failed", "n_shingles", "component_id", "key", "text_key",
             "n_removed", "_column_2", "a.b"]
    more = [*rows, (None, rows[5][1]), (None, None), (rows[12][0], rows[12][1])]
    docs = spark.createDataFrame([(i, t, *[f"{c} of {i}" for c in clash]) for i, t in more],
                                 "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in clash))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes, name
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        for r in docs.collect():
            assert all(r[c] == f"{c} of {r.doc_id}" for c in clash), (name, r)
    ids = [r.doc_id for r in docs.collect()]
    assert len(ids) == len(set(ids)) and None not in ids  # copies of rows and of texts under null ids are gone


def test_stage_folders_go(spark, corpus):
    import os
    from urllib.parse import urlparse

    from tarmac.session import ensure_checkpoint_dir

    folder, _ = corpus
    top = urlparse(ensure_checkpoint_dir(spark)).path
    before = {d for d in os.listdir(top) if d.startswith("corpus_pipeline_")}
    out = corpus_pipeline.run(spark, folder)
    mine, = {d for d in os.listdir(top) if d.startswith("corpus_pipeline_")} - before
    assert os.listdir(f"{top}/{mine}") == ["substring_dedup"]
    assert out.count() > 100
