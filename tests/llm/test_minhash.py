from __future__ import annotations

import random

from tarmac.llm import minhash

from .plain import groups, near_links, shingles


def check(df, rows):
    sets = [shingles(t) for _, t in rows]
    root = groups(len(rows), near_links(sets))
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    want = sorted(((i, len(s), least.get(r) if s else i, (least.get(r) if s else i) == i)
                   for (i, _), s, r in zip(rows, sets, root)), key=key)
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).drop("key", "text_key").collect()), key=key)
    assert got == want


def test_odd_texts_like_brute_force(odd_docs, odd_texts):
    check(odd_docs, odd_texts)


def test_empty_table(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.deduplicated(no_docs).count() == 0


def test_chain_and_dense_group_like_brute_force(spark):
    """Copies that drift from one another, so that only some pairs link, and a
    group whose members differ from a common text."""
    rng = random.Random(4)
    texts = []
    chain = [f"c{i}" for i in range(60)]
    for step in range(14):
        chain = list(chain)
        chain[rng.randrange(60)] = f"n{step}"
        texts.append(" ".join(chain))
    base = [f"b{i}" for i in range(120)]
    for m in range(60):
        copy = list(base)
        for _ in range(rng.randrange(0, 7)):
            copy[rng.randrange(120)] = f"e{m}_{rng.randrange(9)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"u{rng.randrange(5000)}" for _ in range(80)) for _ in range(40)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_blocks_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(50)]
    rows = []
    for m in range(30):
        copy = list(base)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(50)] = f"e{m}_{rng.randrange(9)}"
        rows.append((m, " ".join(copy)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_one_document_of_each_group_stays(odd_docs):
    left = sorted((r.doc_id is None, r.doc_id or 0) for r in minhash.deduplicated(odd_docs).collect())
    assert [i for none, i in left if not none].count(12) == 0
    assert (False, 10) in left and (False, 11) not in left
    assert minhash.deduplicated(odd_docs).columns == odd_docs.columns
