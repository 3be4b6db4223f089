"""Settings and storage shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir

BATCH_ROWS = 1000            # texts in one Arrow batch
BATCH_BYTES = 4 << 20        # their bytes, or one row
BYTES_PER_BUCKET = 16 << 20  # text behind one bucket of packed keys
LEAST_BUCKETS = 64


def prepared(df: DataFrame) -> SparkSession:
    """The session, with the checkpoint folder known and Arrow batches small
    enough for long texts (each limit left alone if the user chose another). The
    limits stay set, as the frames returned are run later; they change no result."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":  # Spark's own
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder, so that later steps neither
    compute them again nor depend on an executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_count(size: int, per_bucket: int = BYTES_PER_BUCKET) -> int:
    """Buckets for keys of ``size`` bytes of text: their content stays equally
    large however much text there is."""
    return max(LEAST_BUCKETS, -(-size // per_bucket))
