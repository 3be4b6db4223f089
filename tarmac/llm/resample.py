"""Quality by importance resampling.

Texts become tokens (lower-cased A-Z; runs of letters and digits, and runs of
other characters), and token unigrams and bigrams are hashed to ``BUCKETS``
buckets. Two generative models are bags of buckets: the raw one counts all
documents, the target one the documents labelled good. A document's log weight
is the sum over its n-grams of log(target / raw). The ``share`` of documents
with the highest log weight + Gumbel noise is taken, which samples without
replacement in proportion to the weights.

The target model is smoothed towards the raw one by ``PRIOR`` n-grams. Labelled
rows are a bounded sample (``samples.SAMPLE_ROWS``); raw counts, weights and the
top k cover every whole text. Models are ``BUCKETS`` numbers each. Noise is a
hash of the id and the text, so a run can be repeated. The top k is found by a
range partitioning and row numbers, never on the driver.

Cases: null or empty text has weight 0; no good labels give weight 0 to all, so
noise decides; an empty table gives an empty result; repeated rows get equal
keys, and which of them is taken at the border makes no difference; other
columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tarmac.llm import samples
from tarmac.llm import text as tx
from tarmac.llm.jobs import prepared, stored

BUCKETS = 10_000
PRIOR = 10_000.0


def grams(t: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each unigram and bigram."""
    data = tx.LOWER[t.data]
    start, end = tx.bounds(data, t.offsets)
    other = tx.NOT_LETTER[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        cut[1:-1] = (other[1:] != other[:-1]) & ~tx.SPACE[data[1:]] & ~tx.SPACE[data[:-1]]
    cut[start] = True
    begin = np.flatnonzero(cut)
    word = np.searchsorted(start, begin, side="right") - 1
    stop = np.minimum(np.append(begin[1:], len(data)), end[word]) if len(begin) else begin
    h = tx.hash_spans(data, begin, stop)
    first = np.searchsorted(begin, t.offsets)
    n = np.diff(first)
    pairs = tx.ragged(first[:-1], np.maximum(n - 1, 0))
    two = tx.hash_windows(h, 2)[pairs] if len(pairs) else h[:0]
    row = np.repeat(np.arange(len(n)), n)
    buckets = np.concatenate((tx.bucket_of(h, BUCKETS), tx.bucket_of(two, BUCKETS)))
    return buckets, np.concatenate((row, np.repeat(np.arange(len(n)), np.maximum(n - 1, 0))))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, raw, target): the counts of a task."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for t in tx.slices(batch.column(0)):
            bucket, row = grams(t)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[t.start + row]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, labels: DataFrame, rows: int = samples.SAMPLE_ROWS) -> np.ndarray:
    """log(target / raw) of each bucket."""
    good = (labels.where(F.col("doc_id").isNotNull() & (F.col("quality") > 0)).select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumn("_good", F.lit(True)))
    marked = docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left")
    counts = (marked.select("text", F.coalesce("_good", F.lit(False)).alias("good"))
              .mapInArrow(_counted, "bucket long, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.ones(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"]] += counts["raw"]
    target[counts["bucket"]] += counts["target"]
    raw /= raw.sum()
    return np.log((target + PRIOR * raw) / (target.sum() + PRIOR)) - np.log(raw)


def _weighed(ratios: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in tx.slices(batch.column(1)):
                bucket, row = grams(t)
                rows = t.stop - t.start
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(t.start, rows), batch.column(2).slice(t.start, rows),
                    pa.array(np.bincount(row, minlength=rows)), pa.array(np.bincount(row, ratios[bucket], rows).astype(float)),
                ], names=["doc_id", "place", "n_grams", "log_weight"])

    return run


def top(rows: DataFrame, k: int, *order) -> DataFrame:
    """``rows`` with ``rank`` (from 1, in the order given) and ``kept`` (rank <= k).
    Rows are range partitioned, so no task or driver holds them all."""
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_row") - F.shiftleft(F.col("_part").cast("long"), 33) + 1
    return (placed.join(F.broadcast(offsets), "_part").withColumn("rank", rank)
            .withColumn("kept", F.col("rank") <= k).drop("_part", "_row", "_before"))


def resampled(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0,
              rows: int = samples.SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, n_grams, log_weight, gumbel_key, rank and
    kept. ``share`` of all documents is kept; None takes the share of good ones
    among the labels."""
    prepared(docs)
    ratios = log_ratios(docs, labels, rows)
    if share is None:
        share = labels.where("quality is not null").agg(F.avg((F.col("quality") > 0).cast("int"))).first()[0]
        share = 1.0 if share is None else float(share)
    placed = docs.select("doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("place"))
    weighed = stored(placed.mapInArrow(_weighed(ratios), StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("place", LongType()),
        StructField("n_grams", LongType()), StructField("log_weight", DoubleType())])))
    uniform = (F.shiftrightunsigned("place", 11).cast("double") + 0.5) / float(1 << 53)
    keyed = weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    k = round(share * weighed.count())
    return top(keyed, k, F.desc("gumbel_key"), F.col("doc_id"), F.col("place")).select(
        "doc_id", "n_grams", "log_weight", "gumbel_key", "rank", "kept")
