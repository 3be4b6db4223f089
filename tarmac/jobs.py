"""Job entry points (``spark-submit -m``-style):

    python -m tarmac.jobs calc --catalog-db mart --prefix bookings_ --table results
    python -m tarmac.jobs calc --parquet-root /data/bookings --table results --path /shared/results
    python -m tarmac.jobs extract-load --url jdbc:postgresql://host/demo --user u \
        --password-file /run/secrets/db --schema bookings --target-db mart \
        --target-root /shared/tables --split flights_v=flight_id --partitions 64

``calc`` answers every question and writes the results table once;
``extract-load`` copies ``seats`` as is and ``flights_v`` partitioned by the
day of ``actual_departure``, reading each source table in parallel strides.
"""

from __future__ import annotations

import argparse
import inspect
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tarmac.constants import RESULTS_TABLE
from tarmac.plans import questions
from tarmac.plans.extract_load import copy_by_day, copy_table
from tarmac.plans.mart import run_mart
from tarmac.session import apply_job_conf, storage_root
from tarmac.sources.jdbc import JdbcSource, ModuloSplit, read_table, split_bounds, split_depths
from tarmac.sources.tables import BookingTables, from_catalog, from_parquet


@dataclass(frozen=True)
class CopySpec:
    """One extract-load copy: source table, target name, optional day column."""

    source: str
    target: str
    day_of: str | None = None
    large: bool = False  # must be read in parallel


# The copies the extract-load job makes (fixed by the mart's needs).
DEFAULT_COPIES = (
    CopySpec("seats", "seats"),
    CopySpec("flights_v", "flights_v", day_of="actual_departure", large=True),
)


def run_calc(spark: SparkSession, tables: BookingTables, table: str = RESULTS_TABLE,
             path: str | None = None, params: dict[str, dict] | None = None) -> DataFrame:
    apply_job_conf(spark)
    return run_mart(spark, tables, table, path or f"{storage_root(spark)}/{table}", params)


def run_extract_load(spark: SparkSession, source: JdbcSource, schema: str | None,
                     target_db: str | None, target_root: str,
                     splits: dict[str, str] | None = None, partitions: int = 1,
                     copies: tuple[CopySpec, ...] = DEFAULT_COPIES,
                     modulo: bool = False, equi_depth: bool = False) -> dict[str, DataFrame]:
    apply_job_conf(spark)
    splits = splits or {}
    out = {}
    for spec in copies:
        qualified = f"{schema}.{spec.source}" if schema else spec.source
        split = None
        if spec.source in splits and partitions > 1:
            column = splits[spec.source]
            split = (ModuloSplit(column, partitions) if modulo
                     else (split_depths if equi_depth else split_bounds)(spark, source, qualified, column, partitions))
        df = read_table(spark, source, qualified, split)
        name = f"{target_db}.{spec.target}" if target_db else spec.target
        path = f"{target_root.rstrip('/')}/{spec.target}"
        if spec.day_of:
            out[spec.target] = copy_by_day(spark, df, spec.day_of, name, path)
        else:
            out[spec.target] = copy_table(spark, df, name, path)
    return out


def _parse(argv=None):
    p = argparse.ArgumentParser(prog="tarmac.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("calc", help="answer all questions into the results table")
    src = c.add_mutually_exclusive_group(required=True)
    src.add_argument("--catalog-db", help="database holding the bookings tables")
    src.add_argument("--parquet-root", help="folder with one parquet folder per table")
    c.add_argument("--prefix", default="", help="what the catalog's table names begin with, e.g. bookings_")
    c.add_argument("--table", default=RESULTS_TABLE)
    c.add_argument("--path", default=None, help="storage path of the results table (default: in the warehouse)")
    c.add_argument("--param", action="append", default=[],
                   help="question.argument=value, e.g. q13_unreachable_from_city.origin=Казань")
    e = sub.add_parser("extract-load", help="copy source tables over JDBC")
    e.add_argument("--url", required=True)
    e.add_argument("--user")
    e.add_argument("--password-file")
    e.add_argument("--driver")
    e.add_argument("--schema")
    e.add_argument("--target-db")
    e.add_argument("--target-root", required=True)
    e.add_argument("--split", action="append", default=[], help="table=column to split the read on")
    e.add_argument("--partitions", type=int, default=0, help="parallel reads of a split table (2 or more)")
    e.add_argument("--one-task", action="append", default=[], metavar="TABLE",
                   help="read this table in one task although it is large")
    how = e.add_mutually_exclusive_group()
    how.add_argument("--modulo", action="store_true",
                     help="split integer keys by residue classes instead of range strides")
    how.add_argument("--equi-depth", action="store_true",
                     help="split integer keys into ranges of about equal row counts (asks for histograms)")
    args = p.parse_args(argv)
    if args.job == "extract-load":
        split = {s.split("=", 1)[0] for s in args.split}
        if split and args.partitions < 2:
            p.error("--split needs --partitions of 2 or more")
        for spec in DEFAULT_COPIES:
            if spec.large and spec.source not in split and spec.source not in args.one_task:
                p.error(f"{spec.source} is large: name a column with --split {spec.source}=COLUMN, "
                        f"or allow a single task with --one-task {spec.source}")
    return args


def _params(items: list[str]) -> dict[str, dict]:
    """``question.argument=value`` items -> keyword arguments per question,
    converted to the type of the argument's default (e.g. ``top`` is int)."""
    out: dict[str, dict] = {}
    for item in items:
        target, value = item.split("=", 1)
        question, arg = target.split(".", 1)
        fn = getattr(questions, question, None)
        if fn is None or arg not in inspect.signature(fn).parameters:
            raise ValueError(f"unknown question parameter {target!r}")
        default = inspect.signature(fn).parameters[arg].default
        typed = type(default)(value) if isinstance(default, (int, float)) else value
        out.setdefault(question, {})[arg] = typed
    return out


def main(argv=None) -> None:
    args = _parse(argv)
    spark = (SparkSession.builder.appName(f"tarmac-{args.job}")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate())
    if args.job == "calc":
        tables = (from_catalog(spark, args.catalog_db, prefix=args.prefix) if args.catalog_db
                  else from_parquet(spark, args.parquet_root))
        run_calc(spark, tables, args.table, args.path, _params(args.param))
    else:
        password = None
        if args.password_file:
            with open(args.password_file, encoding="utf-8") as fh:
                password = fh.read().strip()
        source = JdbcSource(args.url, args.user, password, args.driver)
        splits = dict(s.split("=", 1) for s in args.split)
        run_extract_load(spark, source, args.schema, args.target_db, args.target_root, splits,
                         max(1, args.partitions), modulo=args.modulo, equi_depth=args.equi_depth)


if __name__ == "__main__":
    main()
