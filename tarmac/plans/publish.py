"""Tables that stay readable while they are replaced.

A publication root holds one folder per version and, under ``_published``, an
empty file per version that is complete. A version is written whole under its
own name first; creating its file, which storage does in one step, publishes it.
A write that fails or is killed leaves the newest complete version as it was. A
catalog table follows by having its location changed, which is one change of
its entry. The last ``keep`` versions stay, so that readers of an older one can
finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import remove_folder

KEEP = 2
_MARKS = "_published"


def _storage(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    fs, marks = _storage(spark, f"{root.rstrip('/')}/{_MARKS}")
    if not fs.exists(marks):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(marks) if s.isFile() and not s.getPath().getName().startswith("."))


def _mark(spark: SparkSession, root: str, version: str) -> None:
    fs, path = _storage(spark, f"{root}/{_MARKS}/{version}")
    fs.create(path, False).close()


def _retire(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the last versions; first their marks."""
    for old in versions(spark, root)[:-keep]:
        remove_folder(spark, f"{root}/{_MARKS}/{old}")
        remove_folder(spark, f"{root}/{old}")


def published_folder(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete version."""
    found = versions(spark, root)
    return f"{root.rstrip('/')}/{found[-1]}" if found else None


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest complete version, or None before the first."""
    folder = published_folder(spark, root)
    return spark.read.parquet(folder) if folder else None


def publish(df: DataFrame, root: str, table: str | None = None, keep: int = KEEP) -> str:
    """Write ``df`` as the next version under ``root``, make it the current one
    (and the content of the catalog table ``table``) and return its folder."""
    if keep < 1:
        raise ValueError("the current version must be kept")
    spark, root = df.sparkSession, root.rstrip("/")
    last = versions(spark, root)
    number = int(last[-1].split("-")[0]) + 1 if last else 1
    version = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    folder = f"{root}/{version}"
    try:
        df.write.mode("errorifexists").parquet(folder)
        _mark(spark, root, version)
    except BaseException:
        remove_folder(spark, folder)
        raise
    if table is not None:
        _point(spark, table, folder, df)
    _retire(spark, root, keep)
    return folder


def _point(spark: SparkSession, table: str, folder: str, df: DataFrame) -> None:
    if spark.catalog.tableExists(table):
        quoted = ".".join(f"`{part}`" for part in table.split("."))
        location = folder.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
