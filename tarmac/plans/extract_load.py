"""Extract-load: copy source tables into Spark tables.

``copy_table`` is a plain overwrite copy; ``copy_by_day`` adds a DATE column
derived from a timestamp and partitions the copy by it. Readers that filter
on that column read only the matching day directories. ``sync_by_day`` keeps
such a copy up to date by writing only the days that changed. ``copy_bucketed``
stores a table by a join key.

The source is any DataFrame: a parallel JDBC read (``tarmac.sources.jdbc``)
in production, or the bookings views in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import day
from tarmac.plans.publish import publish, published
from tarmac.session import ensure_checkpoint_dir, remove_folder
from tarmac.sources.tables import DAY_PARTITION_COLUMN, BookingTables


def copy_table(spark: SparkSession, df: DataFrame, table: str, path: str) -> DataFrame:
    """Overwrite ``table`` (stored at ``path``) with ``df``; return the copy."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
    return spark.table(table)


def copy_by_day(spark: SparkSession, df: DataFrame, timestamp: str, table: str, path: str,
                day_column: str = DAY_PARTITION_COLUMN) -> DataFrame:
    """Overwrite ``table`` partitioned by the day of ``timestamp``.

    Rows are rebalanced on the day column before the write: each day's rows
    are gathered into few tasks (few files per directory), while AQE splits a
    day that holds a large share of all rows across several tasks instead of
    one. Rows with a NULL timestamp go to the default partition.
    """
    dated = df.withColumn(day_column, day(timestamp)).hint("rebalance", day_column)
    (
        dated.write.mode("overwrite").format("parquet")
        # a copy replaces every day, also under a session-wide dynamic mode
        .option("partitionOverwriteMode", "static")
        .partitionBy(day_column)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


BUCKETED = ("tickets", "ticket_flights")


def copy_bucketed(spark: SparkSession, df: DataFrame, key: str, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """Overwrite ``table`` stored in ``buckets`` hash buckets of ``key`` (by default
    as many as the session's shuffle partitions), sorted by it. Joins and aggregations on ``key`` between tables of as many buckets
    read them without an exchange. A bucket's rows are gathered into few tasks and
    files; AQE splits a bucket that holds a large share of all rows over several."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.hint("rebalance", key)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def bucketed_tables(spark: SparkSession, t: BookingTables, prefix: str, root: str, buckets: int | None = None) -> BookingTables:
    """``t`` with ``tickets`` and ``ticket_flights`` read from copies bucketed by
    ticket_no (tables ``prefix + name`` under ``root``)."""
    copies = {name: copy_bucketed(spark, getattr(t, name), "ticket_no", prefix + name, f"{root.rstrip('/')}/{name}", buckets)
              for name in BUCKETED}
    return t.replace(**copies)


def day_fingerprints(dated: DataFrame, day_column: str = DAY_PARTITION_COLUMN) -> DataFrame:
    """Per day: number of rows, and xor and sum of the rows' 64-bit hashes. NULLs
    are hashed by place (a hash of values alone would skip them)."""
    columns = [F.col(f"`{c}`") for c in sorted(dated.columns)]
    rows = dated.select(day_column, F.xxhash64(*[c.isNull() for c in columns], *columns).alias("_h"))
    return rows.groupBy(day_column).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("mixed"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("total"))


def changed_days(now: DataFrame, before: DataFrame, day_column: str = DAY_PARTITION_COLUMN) -> DataFrame:
    """Days whose fingerprint differs: (day, ``gone`` if there are no rows now)."""
    both = now.withColumn("_now", F.lit(True)).unionByName(before.withColumn("_now", F.lit(False)))
    seen = both.groupBy(day_column).agg(
        F.count_distinct(F.struct("n", "mixed", "total")).alias("states"), F.count(F.lit(1)).alias("times"), F.bool_or("_now").alias("_there"))
    return seen.where("states > 1 or times = 1").select(day_column, (~F.col("_there")).alias("gone"))


def sync_by_day(spark: SparkSession, df: DataFrame, timestamp: str, path: str,
                day_column: str = DAY_PARTITION_COLUMN) -> DataFrame:
    """Make the copy under ``path``, partitioned by the day of ``timestamp``,
    equal to ``df`` by overwriting only the days that differ from the last time,
    and return the copy.

    The fingerprints of the copied days are published beside the copy
    (``<path>_days``). Before anything is written, the changed days are taken out
    of them, and put in again when all is stored: a run that dies on the way
    leaves days without a fingerprint, which the next run writes again. Both
    tables of days have a row per calendar day.
    """
    ensure_checkpoint_dir(spark)
    path = path.rstrip("/")
    marks = f"{path}_days"
    dated = df.withColumn(day_column, day(timestamp))
    now = day_fingerprints(dated, day_column).checkpoint()
    before = published(spark, marks)
    before = now.where("false") if before is None else before
    changed = changed_days(now, before, day_column).checkpoint()
    settled = before.join(changed, before[day_column].eqNullSafe(changed[day_column]), "left_anti")
    publish(settled.checkpoint(), marks)
    rows = dated.join(changed, dated[day_column].eqNullSafe(changed[day_column]), "left_semi")
    (
        rows.hint("rebalance", day_column).write.mode("overwrite").format("parquet")
        .option("partitionOverwriteMode", "dynamic").partitionBy(day_column).save(path)
    )
    # days that the source has no rows for any more: at most a row per calendar day
    for row in changed.where("gone").collect():
        name = "__HIVE_DEFAULT_PARTITION__" if row[day_column] is None else row[day_column].isoformat()
        remove_folder(spark, f"{path}/{day_column}={name}")
    publish(now, marks)
    return spark.read.schema(dated.schema).parquet(path)
