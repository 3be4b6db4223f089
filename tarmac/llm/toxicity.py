"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the words of a document (lower-cased A-Z) and their first 4, 5
and 6 bytes, hashed; a feature's value is log2(1 + occurrences). From a bounded
sample of labelled documents, the features that tell most about the label are
chosen (Spark counts them; at most ``FEATURES`` come to the driver).

Severity grades 0 (clean), 1 and 2 are made from the 0/1 label: a toxic
document is of grade 2 if its telling features occur at least as often as in
the median toxic document. One weight vector is shared by the ordered
thresholds, P(grade >= k) = sigmoid(w x - t_k), and the severity put out is the
expected grade, the sum of these probabilities. A document is toxic if
P(grade >= 1) >= 0.5.

Training sees ``samples.SAMPLE_ROWS`` labelled rows at most (a parameter);
scoring reads every whole text in one pass without a shuffle. The model that
tasks get holds ``FEATURES`` hashes and weights.

Cases: null or empty text has no features, so it gets the base severity; no
labels, or of one class only, give severity 0 and no toxic documents; an empty
table gives an empty result; repeated rows are scored alike; other columns pass
through, except those named like the outputs, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from tarmac.llm import samples
from tarmac.llm import text as tx
from tarmac.llm.jobs import prepared, stored

PREFIXES = (4, 5, 6)
FEATURES = 4096
LEAST_DOCS = 5       # documents of the sample that must have a feature
GAP = 1e-2
ROUNDS = 300
RATE = 0.3
RIDGE = 1e-4
LOWEST_CUT = 1.0     # so a text without features is not toxic
OUTPUTS = ("severity", "p_toxic", "grade", "toxic")


class Model(NamedTuple):
    hashes: np.ndarray    # uint64, in order
    weights: np.ndarray
    cuts: np.ndarray      # thresholds t_1 <= t_2


def features(t: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each occurrence of a feature."""
    data = tx.LOWER[t.data]
    start, end = tx.bounds(t.data, t.offsets, tx.NOT_LETTER)
    first = np.searchsorted(start, t.offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    h, rows = [tx.hash_spans(data, start, end)], [row]
    for n in PREFIXES:
        at = np.flatnonzero(end - start > n)
        h.append(tx.hash_spans(data, start[at], start[at] + n))
        rows.append(row[at])
    return np.concatenate(h), np.concatenate(rows)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, docs, toxic) over the texts of a task, combined per slice."""
    for batch in batches:
        y = batch.column(1).to_numpy()
        for t in tx.slices(batch.column(0)):
            h, row = features(t)
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, toxic = h[new], y[t.start + row[new]].astype(np.int64)
            h, n, toxic = tx.count_pairs(h, np.ones(len(h), dtype=np.int64), toxic)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(n), pa.array(toxic)], names=["feature", "docs", "toxic"])


def _found(t: tx.Texts, hashes: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index into hashes) of each occurrence of a chosen feature."""
    h, row = features(t)
    at = np.flatnonzero(maybe[h & np.uint64(0xFFFF)])
    h, row = h[at], row[at]
    i = np.searchsorted(hashes, h)
    hit = hashes[np.minimum(i, len(hashes) - 1)] == h if len(hashes) else np.zeros(len(h), dtype=bool)
    return row[hit], i[hit]


def _maybe(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 16, dtype=bool)
    out[hashes & np.uint64(0xFFFF)] = True
    return out


def _values(row: np.ndarray, index: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index, log2(1 + count)), one entry for each that occurs."""
    pair, n = np.unique(row.astype(np.int64) * max(width, 1) + index, return_counts=True)
    return pair // max(width, 1), pair % max(width, 1), np.log2(1 + n)


def _sparse(hashes: np.ndarray):
    """Per document: its label and chosen features (32-bit places and values), packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(hashes)
        for batch in batches:
            for t in tx.slices(batch.column(0)):
                row, index, value = _values(*_found(t, hashes, maybe), len(hashes))
                off = pa.py_buffer(4 * np.searchsorted(row, np.arange(t.stop - t.start + 1)).astype(np.int32))
                packed = [pa.Array.from_buffers(pa.binary(), t.stop - t.start, [None, off, pa.py_buffer(x)])
                          for x in (index.astype("<i4"), value.astype("<f4"))]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(t.start, t.stop - t.start), *packed], names=["y", "index", "value"])

    return run


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def likelihood_slopes(z: np.ndarray, cuts: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of each row's -log P(grade) by its score and by every threshold."""
    n, at = len(z), np.arange(len(z))
    reach = np.column_stack([np.ones(n), _sigmoid(z[:, None] - cuts), np.zeros(n)])  # P(grade >= 0, 1, ..)
    low, high = reach[at, grade], reach[at, grade + 1]
    chance = np.maximum(low - high, 1e-12)
    steep = np.zeros((n, len(cuts) + 2))
    steep[at, grade] = low * (1 - low) / chance
    steep[at, grade + 1] -= high * (1 - high) / chance
    return low + high - 1, steep[:, 1:-1]


def fit_ordinal(row: np.ndarray, index: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
                lowest: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds (``lowest`` or more, at least
    ``GAP`` apart) of a cumulative-link model, by gradient descent with momentum
    on its negative log-likelihood: a grade's probability is the difference of
    the two cumulative ones around it."""
    levels, n = int(grade.max()), len(grade)
    share = np.clip((grade[:, None] >= np.arange(1, levels + 1)).mean(axis=0), 1e-3, 1 - 1e-3)
    cuts = -np.log(share / (1 - share))
    w = np.zeros(width)
    scale = 1 / np.sqrt(np.bincount(index, value**2, width) / n + 1e-3)  # rare features learn as fast
    mw, mc = np.zeros(width), np.zeros(levels)
    for _ in range(ROUNDS):
        z = np.bincount(row, value * w[index], n)
        slope, steep = likelihood_slopes(z, cuts, grade)
        g = np.bincount(index, value * slope[row], width) / n + RIDGE * w
        mw = 0.9 * mw - RATE * scale**2 * g
        mc = 0.9 * mc - RATE * steep.mean(axis=0)
        w += mw
        cuts = np.maximum.accumulate(np.maximum(cuts + mc, lowest) - GAP * np.arange(levels)) + GAP * np.arange(levels)
    return w, cuts


def fit(docs: DataFrame, labels: DataFrame, rows: int = samples.SAMPLE_ROWS) -> Model:
    sample = stored(samples.labelled(docs, labels, "toxic", rows).select("text", "y"))
    n, toxic = sample.agg(F.count("*"), F.sum("y")).first()
    none = Model(np.zeros(0, dtype=np.uint64), np.zeros(0), np.full(2, np.inf))
    if not toxic or toxic == n:
        return none
    counts = (sample.mapInArrow(_counted, "feature long, docs long, toxic long").groupBy("feature")
              .agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")).where(F.col("docs") >= LEAST_DOCS))
    a, b = F.col("toxic"), F.col("docs") - F.col("toxic")
    odds = F.log(((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (n - toxic + 1)))
    told = F.abs(odds) * F.sqrt(F.lit(1.0) / (F.lit(1.0) / (a + 0.5) + F.lit(1.0) / (b + 0.5)))
    top = (counts.withColumns({"odds": odds, "told": told}).orderBy(F.desc("told"), "feature").limit(FEATURES)
           .select("feature", "odds", "told").toPandas())
    if not len(top):
        return none
    hashes = top["feature"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes = hashes[order]
    telling = ((top["odds"] > 3) & (top["told"] > 3)).to_numpy()[order]

    x = sample.mapInArrow(_sparse(hashes), "y int, index binary, value binary").collect()
    row = np.repeat(np.arange(len(x)), [len(r["index"]) // 4 for r in x])
    index = np.frombuffer(b"".join(r["index"] for r in x), dtype="<i4")
    value = np.frombuffer(b"".join(r["value"] for r in x), dtype="<f4").astype(float)
    y = np.array([r.y for r in x]) > 0
    amount = np.bincount(row, np.where(telling[index], 2**value - 1, 0), len(x))
    grade = np.where(y, np.where(amount >= max(np.median(amount[y]), 2), 2, 1), 0)
    if not (grade == 2).any():
        grade = np.minimum(grade, 1)
    return Model(hashes, *fit_ordinal(row, index, value, grade, len(hashes), LOWEST_CUT))


def _score(model: Model, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(model.hashes)
        for batch in batches:
            for t in tx.slices(batch.column(text_at)):
                rows = t.stop - t.start
                row, index, value = _values(*_found(t, model.hashes, maybe), len(model.hashes))
                z = np.bincount(row, value * model.weights[index], rows)
                p = _sigmoid(z[:, None] - model.cuts)
                grade = (p >= 0.5).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(t.start, rows) for i in range(batch.num_columns)]
                    + [pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(grade, type=pa.int32()), pa.array(grade > 0)],
                    names=names)

    return run


def scored(docs: DataFrame, labels: DataFrame, rows: int = samples.SAMPLE_ROWS) -> DataFrame:
    """``docs`` with severity, p_toxic, grade and toxic."""
    prepared(docs)
    model = fit(docs, labels, rows)
    keep = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in OUTPUTS])
    schema = StructType([StructField(f.name, f.dataType, True) for f in keep.schema.fields] + [
        StructField("severity", DoubleType()), StructField("p_toxic", DoubleType()),
        StructField("grade", IntegerType()), StructField("toxic", BooleanType())])
    return keep.mapInArrow(_score(model, keep.columns.index("text"), schema.names), schema)
