"""Licence scan by a trained paragraph classifier.

A block is a run of lines with a word (so comment marks alone are blank). A
paragraph is a window of neighbouring lines of a block, from one line up to as many
as hold ``WINDOW`` times the words of the longest template after the first line, so
a notice is seen whole however it is wrapped. Its features are word unigrams,
bigrams and trigrams (lower-cased A-Z, runs of letters and digits, across line
breaks) that occur in the notice templates below. A softmax regression over these sparse features gives a
licence family or ``unknown``; it is trained on the templates, varied by lost
and added words, and on ``NEGATIVES`` windows of the documents (a bounded sample
of all windows of all whole texts, by hash; only their template n-grams leave the
tasks) as the unknown class. Probabilities are calibrated on a part held out:
a temperature, and the probability that a family must reach so that at most
``FALSE_SHARE`` of unknown windows do. A prediction counts only if a template of
that family confirms it: ``CONFIRM`` of the template's bigrams, weighted equally,
stand in the paragraph. Of windows that share lines the one whose template stands
in it most fully counts, then the one with fewer lines, then the more probable one.

Every window of every whole text is classified in one pass without a shuffle; the
model in the tasks has one weight for each template n-gram and family.

Cases: null or empty text has no paragraphs and no families; an empty table
gives an empty result (and a model trained on templates alone); repeated rows are
scanned alike; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tarmac.llm import text as tx
from tarmac.llm.jobs import prepared

NEGATIVES = 4000
VARIANTS = 60
FALSE_SHARE = 0.001
CONFIRM = 0.6
WINDOW = 2           # words of a window after its first line, by the longest template's
WORD_BYTES = 20      # of a sampled window's first word, used to vary templates
ROUNDS = 300
SEED = 9

# Usual notices by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0", "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL version 2 or later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.", "Licensed under the BSD License", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, Version 2.0.", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License",
    ),
    "isc": ("Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "cc-by": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    ),
    "cc0": ("Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights"),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense"),
    "proprietary": ("Copyright. All rights reserved.", "No part of this work may be reproduced without written permission of the publisher"),
}
FAMILIES = tuple(TEMPLATES)
LONGEST = max(len(v.split()) for texts in TEMPLATES.values() for v in texts)


class Model(NamedTuple):
    hashes: np.ndarray      # template n-grams, in order
    weights: np.ndarray     # n-grams + 1 (bias) x families + 1 (unknown, last)
    temperature: float
    least: float            # probability that a family must reach
    templates: list[tuple[int, np.ndarray]]  # family and its bigrams' places


def paragraphs(t: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (start, end, hash) and the line number of each, counted over all rows."""
    data = tx.LOWER[t.data]
    start, end = tx.bounds(data, t.offsets, tx.NOT_LETTER)
    line = np.cumsum(data == 10)
    extra = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(extra, t.offsets[1:-1], 1)  # rows end lines as well
    number = line[start] + np.cumsum(extra)[start] if len(start) else start
    return start, end, tx.hash_spans(data, start, end), number


def ngrams(h: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, line, n) of all n-grams within lines, n from 1 to 3."""
    out, lines, size = [h], [line], [np.ones(len(h), dtype=np.int64)]
    for n in (2, 3):
        g = tx.hash_windows(h, n)
        inside = line[n - 1 :] == line[: len(g)]
        out.append(g[inside])
        lines.append(line[: len(g)][inside])
        size.append(np.full(int(inside.sum()), n))
    return np.concatenate(out), np.concatenate(lines), np.concatenate(size)


def _texts(values: list[str]) -> tx.Texts:
    data, off = tx.byte_view(pa.array(values, type=pa.large_string()))
    return tx.Texts(data, off, 0, len(values))


def _design(values: list[str], hashes: np.ndarray) -> np.ndarray:
    """Lines x n-grams (0 or 1) and a bias."""
    x = np.zeros((len(values), len(hashes) + 1))
    x[:, -1] = 1
    _, _, h, line = paragraphs(_texts([v.replace("\n", " ") for v in values]))
    g, row, _ = ngrams(h, line)
    at = np.minimum(np.searchsorted(hashes, g), len(hashes) - 1)
    hit = hashes[at] == g
    x[row[hit], at[hit]] = 1
    return x


def _varied(text: str, fillers: list[str], rng: np.random.Generator) -> str:
    words = [w for w in text.split() if rng.random() > 0.04]
    for _ in range(int(rng.integers(0, 4))):
        words.insert(int(rng.choice((0, len(words)))), fillers[int(rng.integers(len(fillers)))])
    return " ".join(words)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def vocabulary() -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The templates' n-grams, in order, and each one's family and bigrams (places)."""
    grams, templates = [], []
    for f, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            _, _, h, line = paragraphs(_texts([text]))
            g, _, n = ngrams(h, line)
            grams.append(g)
            templates.append((f, np.unique(g[n == 2]) if (n == 2).any() else np.unique(g)))
    hashes = np.unique(np.concatenate(grams))
    return hashes, [(f, np.searchsorted(hashes, g)) for f, g in templates]


class Negatives(NamedTuple):
    """Windows of the documents that show no template."""

    cells: list[np.ndarray]  # their template n-grams
    words: list[str]         # some words of theirs


def train(negatives: Negatives) -> Model:
    rng = np.random.default_rng(SEED)
    hashes, templates = vocabulary()
    fillers = negatives.words or ["the"]
    texts, y = [], []
    for f, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            texts += [text, *(_varied(text, fillers, rng) for _ in range(VARIANTS))]
            y += [f] * (VARIANTS + 1)
    # words of the notices alone, out of order, are no notice
    pool = [w for texts_of in TEMPLATES.values() for v in texts_of for w in v.split()]
    mixed = [" ".join(rng.choice(pool, size=int(rng.integers(1, 6)))) for _ in range(400)]
    plain = np.zeros((len(negatives.cells), len(hashes) + 1))
    plain[:, -1] = 1
    for r, cells in enumerate(negatives.cells):
        plain[r, cells] = 1
    x_neg = np.concatenate((plain, _design(mixed, hashes)))
    own = np.array([max(x_neg[r, g].mean() for _, g in templates) for r in range(len(x_neg))])
    real = np.arange(len(x_neg)) < len(plain)
    x_neg, real = x_neg[own < CONFIRM], real[own < CONFIRM]  # a window that shows a template is not a negative
    x = np.concatenate((_design(texts, hashes), x_neg))
    real = np.concatenate((np.zeros(len(y), dtype=bool), real))  # windows of the documents
    y = np.concatenate((y, np.full(len(x_neg), len(FAMILIES))))

    held = rng.random(len(y)) < 0.3
    w = np.zeros((x.shape[1], len(FAMILIES) + 1))
    speed = np.zeros_like(w)
    target = np.eye(len(FAMILIES) + 1)[y[~held]]
    for _ in range(ROUNDS):
        slope = x[~held].T @ (_softmax(x[~held] @ w) - target) / len(target) + 1e-4 * w
        speed = 0.9 * speed - 1.0 * slope
        w += speed
    z = x[held] @ w
    temps = np.geomspace(0.25, 4, 17)
    loss = [-np.log(_softmax(z / t)[np.arange(len(z)), y[held]] + 1e-12).mean() for t in temps]
    temperature = float(temps[int(np.argmin(loss))])
    p = _softmax(z / temperature)[real[held], :-1].max(axis=1, initial=0)
    least = max(0.5, float(np.quantile(p, 1 - FALSE_SHARE))) if len(p) else 0.5
    return Model(hashes, w, temperature, min(least, 0.99), templates)


class Lines(NamedTuple):
    """Lines with a word, of some texts."""

    number: np.ndarray   # of each, counted over all rows; a gap ends a block
    before: np.ndarray   # words before each, and all
    block: np.ndarray

    def longer(self, live: np.ndarray, more: int) -> np.ndarray:
        """Those of the lines ``live`` from which a window of ``more`` more lines begins."""
        live = live[live + more < len(self.number)]
        return live[(self.block[live + more] == self.block[live]) & (self.before[live + more] - self.before[live + 1] < WINDOW * LONGEST)]


def _lines(line: np.ndarray) -> Lines:
    numbers, words = np.unique(line, return_counts=True)
    return Lines(numbers, np.concatenate(([0], np.cumsum(words))), np.cumsum(np.concatenate(([True], np.diff(numbers) > 1))))


def _hits(h: np.ndarray, line: np.ndarray, hashes: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template n-grams within blocks: place, first and last line, by first line."""
    block = np.cumsum(np.concatenate(([False], np.diff(line) > 1)))
    cells, firsts, lasts = [], [], []
    for n in (1, 2, 3):
        g = h if n == 1 else tx.hash_windows(h, n)
        at = np.flatnonzero(maybe[g & np.uint64(0xFFFF)] & (block[n - 1 :] == block[: len(g)]))
        i = np.minimum(np.searchsorted(hashes, g[at]), len(hashes) - 1)
        hit = hashes[i] == g[at]
        cells.append(i[hit])
        firsts.append(line[at[hit]])
        lasts.append(line[at[hit] + n - 1])
    cells, firsts, lasts = map(np.concatenate, (cells, firsts, lasts))
    order = np.argsort(firsts, kind="stable")
    return cells[order], firsts[order], lasts[order]


def _maybe(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 16, dtype=bool)
    out[hashes & np.uint64(0xFFFF)] = True
    return out


def _sampled(rows: int, hashes: np.ndarray, templates: list[tuple[int, np.ndarray]]):
    """The windows with the least hashes of a task's texts, by their template
    n-grams, from anywhere in the texts: of the windows that begin at a line,
    one by its hash. Windows of blocks that show a template are left out."""
    maybe = _maybe(hashes)
    owner = [np.asarray(cells) for _, cells in templates]

    def notices(cells: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Blocks that hold ``CONFIRM`` of a template's bigrams."""
        own, row = np.unique(block, return_inverse=True)
        out = []
        for at in range(0, len(own), 1024):
            here = (row >= at) & (row < at + 1024)
            held = np.zeros((min(1024, len(own) - at), len(hashes)), dtype=bool)
            held[row[here] - at, cells[here]] = True
            out.append(np.max([held[:, c].mean(axis=1) for c in owner], axis=0) >= CONFIRM)
        return own[np.concatenate(out)] if out else own

    def sample(t: tx.Texts, least: np.uint64) -> list[tuple[int, bytes, str]]:
        start, end, h, line = paragraphs(t)
        if not len(h):
            return []
        line = line + np.searchsorted(t.offsets, start, side="right")  # rows end blocks as well
        lines = _lines(line)
        longest = np.zeros(len(lines.number), dtype=np.int64)
        live, more = np.arange(len(longest)), 1
        while len(live := lines.longer(live, more)):
            longest[live] = more
            more += 1
        first = lines.before[:-1]
        begin = tx.mix(tx._span_sums(h, tx.WORD_BASE, first, lines.before[1:]))
        last = np.arange(len(longest)) + (begin % (longest + 1).astype(np.uint64)).astype(np.int64)
        name = tx.mix(tx._span_sums(h, tx.WORD_BASE, first, lines.before[last + 1]) + last.astype(np.uint64) - np.arange(len(last), dtype=np.uint64))
        chosen = np.flatnonzero(name < least)
        if not len(chosen):
            return []
        cells, firsts, lasts = _hits(h, line, hashes, maybe)
        of_line = np.searchsorted(lines.number, firsts)
        chosen = chosen[~np.isin(lines.block[chosen], notices(cells, lines.block[of_line]))]
        _, one = np.unique(name[chosen], return_index=True)
        chosen = chosen[one][:rows]
        low, high = np.searchsorted(firsts, lines.number[chosen]), np.searchsorted(firsts, lines.number[last[chosen]], side="right")
        out = []
        for k, a, b in zip(chosen.tolist(), low.tolist(), high.tolist()):
            inside = np.unique(cells[a:b][lasts[a:b] <= lines.number[last[k]]]).astype(np.uint16)
            word = lines.before[k]
            out.append((int(name[k]), inside.tobytes(), bytes(t.data[start[word] : min(end[word], start[word] + WORD_BYTES)]).decode("utf-8", "replace")))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[bytes, str]] = {}
        least = np.uint64((1 << 64) - 1)
        for batch in batches:
            for t in tx.slices(batch.column(0)):
                best |= {name: rest for name, *rest in sample(t, least)}
                if len(best) > rows:
                    best = dict(sorted(best.items())[:rows])
                    least = np.uint64(max(best))
        names = np.array(sorted(best), dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([
            pa.array((names ^ np.uint64(1 << 63)).view(np.int64)), pa.array([best[int(n)][0] for n in names], type=pa.binary()),
            pa.array([best[int(n)][1] for n in names], type=pa.string())], names=["name", "cells", "word"])

    return run


def sample_windows(docs: DataFrame, rows: int = NEGATIVES) -> Negatives:
    """``rows`` distinct windows of all documents with the least hashes. What
    comes to the driver is a window's n-grams of the templates and a word of at
    most ``WORD_BYTES`` bytes, however long its text is."""
    hashes, templates = vocabulary()
    found = docs.select("text").mapInArrow(_sampled(rows, hashes, templates), "name long, cells binary, word string")
    # a window may come from several tasks; after this shuffle the driver gets at
    # most ``rows`` from each of its partitions, not from each task of the scan
    distinct = found.groupBy("name").agg(F.first("cells").alias("cells"), F.first("word").alias("word"))
    chosen = distinct.orderBy("name").limit(rows).collect()
    return Negatives([np.frombuffer(r.cells, dtype=np.uint16).astype(np.int64) for r in chosen], [r.word for r in chosen[:200]])


def _scan(model: Model):
    maybe = _maybe(model.hashes)
    width = len(model.hashes)

    owner = np.array([f for f, _ in model.templates])
    share = np.zeros((width + 1, len(owner)))
    for k, (_, cells) in enumerate(model.templates):
        share[cells, k] = 1 / len(cells)
    paired = np.zeros(width, dtype=bool)  # n-grams that confirm a template
    paired[np.concatenate([cells for _, cells in model.templates])] = True

    def windows(line: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last line of all windows from a line in ``begins`` to one in ``ends``."""
        lines = _lines(line)
        numbers, last = lines.number, np.isin(lines.number, ends)
        live = np.flatnonzero(np.isin(numbers, begins))
        firsts, lasts = [], []
        more = 0
        while len(live):
            here = live[last[live + more]]
            firsts.append(numbers[here])
            lasts.append(numbers[here + more])
            more += 1
            live = lines.longer(live, more)
        return np.concatenate(firsts or [line[:0]]), np.concatenate(lasts or [line[:0]])

    def classify(t: tx.Texts) -> tuple[np.ndarray, ...]:
        """Row, start, end, family and probability of each licence paragraph."""
        start, end, h, line = paragraphs(t)
        nothing = tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0),)
        if not len(h):
            return nothing
        line = line + np.searchsorted(t.offsets, start, side="right")  # rows end blocks as well
        cells, firsts, lasts = _hits(h, line, model.hashes, maybe)
        of = paired[cells]
        low, high = windows(line, firsts[of], lasts[of])
        found: list[tuple] = []
        for a in range(0, len(low), 2048):
            lo, hi = low[a : a + 2048], high[a : a + 2048]
            begin = np.searchsorted(firsts, lo)
            size = np.searchsorted(firsts, hi, side="right") - begin
            at, r = tx.ragged(begin, size), np.repeat(np.arange(len(lo)), size)
            own = lasts[at] <= hi[r]
            x = np.zeros((len(lo), width + 1))
            x[r[own], cells[at[own]]] = 1
            x[:, -1] = 1
            held = x @ share
            shown = np.flatnonzero(held.max(axis=1) >= CONFIRM - 1e-9)
            p = _softmax(x[shown] @ model.weights / model.temperature)
            best = p[:, :-1].argmax(axis=1)
            held = np.where(owner == best[:, None], held[shown], 0).max(axis=1)
            chance = p[np.arange(len(p)), best]
            for r in np.flatnonzero((chance >= model.least) & (p.argmax(axis=1) < len(FAMILIES)) & (held >= CONFIRM - 1e-9)):
                found.append((-round(held[r], 9), hi[shown[r]] - lo[shown[r]], -chance[r], lo[shown[r]], hi[shown[r]], best[r]))
        if not found:
            return nothing
        taken: set[int] = set()
        kept = []
        for _, _, p, lo, hi, f in sorted(found):
            if taken.isdisjoint(range(lo, hi + 1)):
                taken.update(range(lo, hi + 1))
                words = slice(*np.searchsorted(line, [lo, hi + 1]))
                kept.append((start[words][0], end[words][-1], f, -p))
        s, e, f, p = map(np.array, zip(*sorted(kept)))
        return np.searchsorted(t.offsets, s, side="right") - 1, s, e, f, p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(FAMILIES)
        for batch in batches:
            for t in tx.slices(batch.column(1)):
                row, s, e, f, p = classify(t)
                off = np.searchsorted(row, np.arange(t.stop - t.start + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([
                    pa.array(names[f.astype(int)].tolist(), type=pa.string()), pa.array(p.astype(float)),
                    pa.array([bytes(t.data[a:b]).decode("utf-8", "replace") for a, b in zip(s, e)], type=pa.string()),
                ], names=["family", "probability", "paragraph"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.start, t.stop - t.start), pa.ListArray.from_arrays(off, spans)], names=["doc_id", "notices"])

    return run


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, and ``notices``, a list of (family,
    probability, paragraph) in the order of the text."""
    prepared(docs)
    model = train(sample_windows(docs))
    notice = StructType([StructField("family", StringType()), StructField("probability", DoubleType()), StructField("paragraph", StringType())])
    return docs.select("doc_id", "text").mapInArrow(_scan(model), StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("notices", ArrayType(notice))]))


def families(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_notices, families (distinct, in order,
    joined by commas; empty if none) and the least probability of a notice."""
    return scanned(docs).select(
        "doc_id", F.size("notices").cast(LongType()).alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.col("notices.family"))), ",").alias("families"),
        F.array_min(F.col("notices.probability")).alias("least_probability"))
