"""Quality rules as a learned decision list.

Statistics of every whole text are computed in tasks. From those of labelled
documents (quality 0 or 1) sequential covering learns an ordered list of
conjunctions of thresholds: a rule for low quality is *grown* on two thirds of
the sample, threshold by threshold, by information gain; *pruned* on the last
third, where trailing conditions that do not help go; and kept while it is
precise. Documents it covers are taken out, and the next rule is learned. The
list is emitted as one Spark ``CASE`` expression over the statistics.

The sample has at most ``samples.SAMPLE_ROWS`` labelled rows (a parameter);
the rules are applied to all documents.

Cases: null text counts as no words; an empty table gives an empty result; no
labels, or of one class only, give no rules, so ``kept`` is ``not
base_failed``; rows repeated are judged alike; other columns pass through,
except those named like the statistics, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tarmac.llm import samples
from tarmac.llm import text as tx
from tarmac.llm.jobs import prepared

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 50
REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Shares used by the rules; the first names are counted per character or word.
SHARES = ("symbol_share", "upper_share", "digit_share", "mark_share", "pipe_share", "exclaim_share",
          "mean_word", "dup_line_share", "repeat_share", "distinct_share", "beyond_ascii_share", "stop_share")

MAX_RULES = 12
MAX_CONDITIONS = 4
CUTS = 24            # thresholds tried per statistic
LEAST_COVER = 5      # rows a rule must cover in each part
LEAST_PRECISION = 0.9

_UPPER, _DIGIT, _MARK = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _by_row(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """Order by row and hash, given rows in order."""
    order = np.argsort(h)
    r = row[order].astype(np.uint16 if rows < 1 << 16 else np.int64)
    return order[np.argsort(r, kind="stable")]


def _same_as_last(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), dtype=bool)
    out[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    return out


def statistics(t: tx.Texts) -> dict[str, np.ndarray]:
    """COUNTS and SHARES of each row."""
    w = tx.words_of(t)
    rows, n = len(w.first) - 1, np.diff(w.first)
    space = tx.SPACE[t.data]
    chars = _per_row(((t.data & 0xC0) != 0x80) & ~space, t.offsets)
    row = w.row

    edge = np.unique(np.concatenate((t.offsets, nl := np.flatnonzero(t.data == 10), nl + 1)))
    at = np.searchsorted(w.start, edge)
    lines = np.flatnonzero(np.diff(at) > 0)  # parts between line ends that have a word
    line_row = row[at[lines]]
    line_hash = tx.hash_spans(t.data, edge[lines], edge[lines + 1])
    order = _by_row(line_row, line_hash, rows)
    dup = _same_as_last(line_row[order], line_hash[order])
    n_lines = np.bincount(line_row, minlength=rows)
    n_dup = np.bincount(line_row[order][dup], minlength=rows)

    many = np.maximum(n - 2, 0)
    start = tx.ragged(w.first[:-1], many)
    win_row = np.repeat(np.arange(rows), many)
    win = tx.hash_windows(w.hash, 3)[start]
    order = _by_row(win_row, win, rows)
    again = _same_as_last(win_row[order], win[order])
    again[:-1] |= again[1:]
    start = start[order[again]]
    covered = np.zeros(len(w.start), dtype=bool)
    for i in range(3):
        covered[start + i] = True
    n_repeat = _per_row(covered, w.first)

    order = _by_row(row, w.hash, rows)
    distinct = n - np.bincount(row[order][_same_as_last(row[order], w.hash[order])], minlength=rows)
    length = np.maximum(np.diff(t.offsets), 1)
    words = np.maximum(n, 1)
    short = _per_row((w.end - w.start) <= 3, w.first)
    symbols = _per_row(SYMBOLS[t.data], t.offsets)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "symbol_share": symbols / words, "upper_share": _per_row(_UPPER[t.data], t.offsets) / length,
        "digit_share": _per_row(_DIGIT[t.data], t.offsets) / length,
        "mark_share": _per_row(_MARK[t.data], t.offsets) / length,
        "pipe_share": _per_row(t.data == 124, t.offsets) / words,
        "exclaim_share": _per_row(t.data == 33, t.offsets) / words,
        "mean_word": chars / words, "dup_line_share": n_dup / np.maximum(n_lines, 1),
        "repeat_share": n_repeat / words, "distinct_share": distinct / words,
        "beyond_ascii_share": _per_row(t.data > 127, t.offsets) / length, "stop_share": short / words,
    }


def _measure(text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in tx.slices(batch.column(text_at)):
                s = statistics(t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(t.start, t.stop - t.start) for i in range(batch.num_columns)]
                    + [pa.array(s[c], type=pa.int64()) for c in COUNTS]
                    + [pa.array(s[c], type=pa.float64()) for c in SHARES], names=names)

    return run


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics as columns."""
    keep = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (*COUNTS, *SHARES, "base_failed", "kept")])
    schema = StructType([StructField(f.name, f.dataType, True) for f in keep.schema.fields]
                        + [StructField(c, LongType()) for c in COUNTS] + [StructField(c, DoubleType()) for c in SHARES])
    return keep.mapInArrow(_measure(keep.columns.index("text"), schema.names), schema)


class Condition(NamedTuple):
    column: str
    above: bool      # >= cut, else < cut
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.column] >= self.cut if self.above else x[self.column] < self.cut

    def expression(self) -> Column:
        c = F.col(self.column)
        return c >= F.lit(self.cut) if self.above else c < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.column} {'>=' if self.above else '<'} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the condition with the most information gain while there is one
    and good rows are still covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for c in SHARES:
            v = x[c][inside]
            b = bad[inside]
            cuts = np.unique(np.quantile(np.concatenate((v, v[b])), np.linspace(0, 1, CUTS + 1)[1:-1], method="nearest"))
            for cut in np.unique(np.concatenate((cuts, [v[b].min(), np.nextafter(v[b].max(), np.inf)]))):
                for above in (True, False):
                    hit = v >= cut if above else v < cut
                    p = (hit & b).sum()
                    q = hit.sum() - p
                    if p < LEAST_COVER:
                        continue
                    g = p * (np.log2(p / (p + q)) - np.log2(p0 / (p0 + n0)))
                    if g > gain:
                        best, gain = Condition(c, above, float(cut)), g
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, float]:
    """Precision (smoothed) and cover among the rows."""
    hit = _covers(rule, x, len(bad))
    p = (hit & bad).sum()
    return (p + 1) / (hit.sum() + 2), p


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule that is most precise; the shortest at a tie."""
    return max((rule[:i] for i in range(1, len(rule) + 1)), key=lambda r: (_worth(r, x, bad)[0], -len(r)))


def learn(x: dict[str, np.ndarray], good: np.ndarray) -> list[Rule]:
    """An ordered list of rules for rows that are not good. Rows come in the
    order of a hash, so every third is a fair sample for pruning."""
    bad = ~good
    part = np.arange(len(bad)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES:
        grow, check = left & ~part, left & part
        if (bad & grow).sum() < LEAST_COVER or (bad & check).sum() < 1:
            break
        rule = _grow({c: v[grow] for c, v in x.items()}, bad[grow])
        if not rule:
            break
        pruned = _prune(rule, {c: v[check] for c, v in x.items()}, bad[check])
        hit = _covers(pruned, x, len(bad)) & left
        if (hit & bad).sum() < LEAST_PRECISION * hit.sum() or (hit & bad).sum() < LEAST_COVER:
            break
        rules.append(pruned)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, rows: int = samples.SAMPLE_ROWS) -> list[Rule]:
    sample = (measured(samples.labelled(docs, labels, "quality", rows))
              .select("y", F.xxhash64("doc_id").alias("place"), *SHARES).toPandas().sort_values("place", kind="stable"))
    if not len(sample):
        return []
    return learn({c: sample[c].to_numpy() for c in SHARES}, sample["y"].to_numpy() > 0)


def verdict(rules: list[Rule]) -> Column:
    """True for documents that no rule covers."""
    out = None
    for rule in rules:
        condition = F.lit(True)
        for c in rule:
            condition = condition & c.expression()
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judged(docs: DataFrame, labels: DataFrame, rows: int = samples.SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the statistics, ``base_failed`` and ``kept``."""
    prepared(docs)
    rules = fit(docs, labels, rows)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (measured(docs).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))
