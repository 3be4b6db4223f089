"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, y) of the ``rows`` labelled documents with the least
    hash of their id, one row for each id. Null ids or labels are left out; an id
    labelled more than once takes its largest label, an id with several texts the
    one with the least hash. Only the sample's ids (``rows`` at most) are
    broadcast; texts of one id meet as one partial row a task."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    chosen = (known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("y").alias("y"))
