"""Query keys of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, caps, decreasing, licences, lm, minhash, packing, repair, repeats, resample, residues, rules, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = packing.pieces(docs, tokenizer_file("word_bpe_49k.json"))
    return packing.packed(parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, ranks, PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resampled(docs, _table(spark, sf_dir, "labels"))


def op5_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).drop("key", "text_key")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(docs, _table(spark, sf_dir, "labels")).select(
        "doc_id", *rules.COUNTS, "base_failed", "kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.families(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.scored(docs, _table(spark, sf_dir, "labels")).select("doc_id", *toxicity.OUTPUTS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", label)
    return residues.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_first_fit_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decreasing.packed(docs, tokenizer_file("word_bpe_49k.json"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(repair.damaged(_table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_lm_scoring,
        op2_best_fit_packing,
        op3_byte_bpe,
        op4_importance_resampling,
        op5_spherical_caps,
        op6_substring_dedup,
        op7_minhash_near_dedup,
        op8_quality_rules,
        op9_license_scan,
        op10_toxicity,
        op11_hard_negatives,
        op12_first_fit_decreasing,
        op13_conversation_repair,
    )}


OP11_SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
    from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
    select a.vec_id as anchor_id, r.vec_id as other_id, r.label = a.label as same,
           cast(list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2])) as bigint) as score
    from rows a join rows r on r.vec_id <> a.vec_id and len(r.q) = len(a.q)
    where a.vec_id % 100 = 0
), positives as (
    select anchor_id, other_id as positive_id, score as positive_score from pairs where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id, n.other_id as negative_id, p.positive_score, n.score as negative_score,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) as int) as rank
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
 and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
qualify rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_hard_negatives": OP11_SQL}
