"""Corpus pipeline: toxic and low-quality documents go, one document of each
near-duplicate group stays, repeated passages are cut out, and what is left is
packed into training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet under the checkpoint folder and reads it again for
the next stage; a result goes when the next one is written. All but the last
return the columns of ``documents``. Labels for the two learned stages come from
``labels`` in ``sf_dir``.

Cases: null and empty texts are never toxic and go with the quality rules, as
do all with fewer than 50 words; a null id is a document like others; of documents
with equal or near texts the one with the least id stays (an id beats a null),
and of repeated rows one; extra columns pass through whatever their names are,
also those named like an operator's outputs; ``n_chars``, if there, follows the
cut text; empty tables give an empty result.

No stage can be stated in SQL (models are fitted, links are transitive), so
``ORACLE_SQL`` is None; ``tests/llm`` holds the pipeline against a plain version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import minhash, packing, repeats, rules, toxicity
from tarmac.llm.queries import tokenizer_file
from tarmac.session import ensure_checkpoint_dir, remove_folder

ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _kept(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stage's rows with the columns of ``docs``. Columns other than the id
    and text go through under names of their own, so that no operator's outputs
    replace them."""
    names = {c: c if c in ("doc_id", "text") else f"_column_{i}" for i, c in enumerate(docs.columns)}
    out = stage(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, lambda d: toxicity.scored(d, _labels(spark, sf_dir)).where("not toxic"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, lambda d: rules.judged(d, _labels(spark, sf_dir)).where("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, minhash.deduplicated)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = _kept(docs, repeats.remove_repeats)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = packing.pieces(docs, tokenizer_file("word_bpe_49k.json"))
    return packing.packed(parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus_pipeline_{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
