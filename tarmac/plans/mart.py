"""The results mart: every answer in one ``(id INT, response STRING)`` table.

All answers are one ``unionByName`` plan written as a new version of the table
(``tarmac.plans.publish``), so a second run replaces the table instead of
appending to it (idempotent), readers see the old answers until all new ones
are stored, and a run that dies leaves them in place. Task failures
inside the write are retried by Spark's commit protocol. Shared sub-plans
of the questions (the per-ticket leg aggregates, the flight views) appear
once in the physical plan thanks to exchange reuse.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tarmac.constants import RESULTS_TABLE
from tarmac.plans.publish import publish
from tarmac.plans.questions import CANONICAL, booking_facts, flight_facts, ticket_totals
from tarmac.session import remove_folder, scratch_root, storage_root
from tarmac.sources.tables import BookingTables

RESULTS_SCHEMA = StructType([
    StructField("id", IntegerType(), True),
    StructField("response", StringType(), True),
])


def build_results(t: BookingTables, params: dict[str, dict] | None = None) -> DataFrame:
    """All canonical answers as one lazy DataFrame; ``params`` maps a
    question name to its keyword arguments (cities, days)."""
    params = params or {}
    answers = [question(t, **params.get(question.__name__, {})) for question in CANONICAL]
    return reduce(lambda a, b: a.unionByName(b), answers)


def stage_facts(spark: SparkSession, t: BookingTables, folder: str) -> BookingTables:
    """Write the fact aggregates shared by several questions once, to
    ``folder`` in the shared storage, and return tables that read them.

    Run alone, each question prunes the shared aggregates to its own columns,
    so their plans differ and Spark cannot reuse their shuffles; the mart
    would scan and shuffle the fact table once per question. Stored once,
    the fact table is scanned twice per run (per ticket, per flight), the
    tickets are aggregated per booking once, q05-q09 are one pass of grouping
    sets over the ticket rows (stored by set, so each question reads its own),
    and each question reads only the columns it needs from the stored copies. The copy
    also cuts the lineage: a lost executor never recomputes the fact-table
    pass. Overwritten each run, so reruns are idempotent.
    """
    facts = {"ticket_totals": ticket_totals(t), "flight_facts": flight_facts(t),
             "booking_facts": booking_facts(t)}
    by = {"ticket_totals": ["set"]}
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in facts}

    def write(name: str) -> None:
        facts[name].write.mode("overwrite").partitionBy(*by.get(name, [])).parquet(paths[name])

    # The writes are independent jobs: submit them together so their stages
    # share the cluster instead of running one after the other.
    with ThreadPoolExecutor(max_workers=len(facts)) as pool:
        for done in [pool.submit(write, name) for name in facts]:
            done.result()
    return t.replace(derived={name: spark.read.schema(facts[name].schema).parquet(path) for name, path in paths.items()})


def write_results(df: DataFrame, table: str = RESULTS_TABLE, path: str | None = None,
                  mode: str = "overwrite") -> None:
    """Write answers to the results table.

    ``overwrite`` publishes a new version under ``path`` (by default in the
    warehouse), so the table is never seen half replaced; ``append`` adds rows,
    for running one question into an existing table. Columns are cast to the
    table schema ``(id INT, response STRING)`` either way.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULTS_SCHEMA.fields])
    spark = df.sparkSession
    root = path or f"{storage_root(spark)}/tarmac_tables/{table}"
    if mode == "overwrite" or not spark.catalog.tableExists(table):
        publish(typed, root, table)
    else:
        typed.write.mode("append").insertInto(table)


def append_answer(spark: SparkSession, question, t: BookingTables, table: str = RESULTS_TABLE,
                  path: str | None = None, **params) -> DataFrame:
    """Append one question's answer rows to the results table (creating it
    if needed) and return the table. Unlike the mart, running the same
    question twice appends its rows twice."""
    write_results(question(t, **params), table, path, mode="append")
    return spark.table(table)


def run_mart(spark: SparkSession, t: BookingTables, table: str = RESULTS_TABLE,
             path: str | None = None, params: dict[str, dict] | None = None,
             stage_folder: str | None = None) -> DataFrame:
    """Stage the shared facts, build every answer, write once, remove the stage
    (unless its folder was given) and return the table as stored."""
    folder = stage_folder or f"{scratch_root(spark)}/tarmac_stage_{uuid.uuid4().hex}"
    try:
        write_results(build_results(stage_facts(spark, t, folder), params), table, path)
    finally:
        if stage_folder is None:
            remove_folder(spark, folder)
    return spark.table(table)
