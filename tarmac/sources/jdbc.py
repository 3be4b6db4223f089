"""JDBC extract: database table -> DataFrame, read in parallel.

A JDBC read without partition options runs as a single task over a single
connection. Here a numeric (or date/timestamp) column splits the table into
``num_partitions`` range strides, one connection and one task each; rows
outside [lower, upper] still land in the first/last stride, so nothing is lost.
When values cluster (one dense range would make one huge stride), an integer
key can be split by a histogram of its values into ranges of about equal row
counts (:class:`EquiDepthSplit`, which still can use an index), or by residue
classes (:class:`ModuloSplit`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetch_size: int = 10_000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "fetchsize": str(self.fetch_size)}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver is not None:
            opts["driver"] = self.driver
        opts.update(self.extra)
        return opts


@dataclass(frozen=True)
class Split:
    """Range split of a JDBC read on ``column`` into ``num_partitions`` strides."""

    column: str
    lower: int | str
    upper: int | str
    num_partitions: int

    def options(self) -> dict[str, str]:
        if self.num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.num_partitions),
        }


@dataclass(frozen=True)
class ModuloSplit:
    """Split a JDBC read on an integer ``column`` into ``num_partitions``
    residue classes (``MOD(column, n) = k``), one task and one connection
    each. Unlike range strides, a dense or clustered range of values is
    spread over all tasks; rows with a NULL ``column`` get their own task.
    The trade-off is on the database side: a ``MOD`` predicate cannot use an
    index, so each task scans the table, whereas range strides on an indexed
    key are index range scans. Prefer :class:`Split` for dense indexed keys."""

    column: str
    num_partitions: int

    def predicates(self) -> list[str]:
        """One predicate per residue class k, plus NULL keys. ``MOD`` of a
        negative number is negative in most databases (-7 mod 4 = -3), so
        class k also takes residue k - n: every key lands in exactly one
        class whichever sign convention the database uses."""
        if self.num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        n, c = self.num_partitions, self.column
        preds = [f"MOD({c}, {n}) = 0"]
        preds += [f"MOD({c}, {n}) IN ({k}, {k - n})" for k in range(1, n)]
        return preds + [f"{c} IS NULL"]


@dataclass(frozen=True)
class EquiDepthSplit:
    """Split a JDBC read on ``column`` at ``bounds`` (in order): a task each for
    the rows below the first, between two and from the last on, and for NULL keys."""

    column: str
    bounds: tuple[int, ...]

    def predicates(self) -> list[str]:
        c, b = self.column, self.bounds
        if not b:
            return [f"{c} IS NOT NULL", f"{c} IS NULL"]
        between = [f"{c} >= {x} AND {c} < {y}" for x, y in zip(b, b[1:])]
        return [f"{c} < {b[0]}", *between, f"{c} >= {b[-1]}", f"{c} IS NULL"]


CELLS = 1000  # of one histogram query: the rows it returns to the driver


class Cell(NamedTuple):
    """``rows`` rows with keys from ``low`` to ``high``, both included."""

    low: int
    high: int
    rows: int


def equi_depth_bounds(count: Callable[[int, int, int], list[Cell]], low: int, high: int, parts: int,
                      cells: int = CELLS) -> tuple[int, ...]:
    """Bounds between ``parts`` ranges of about equal row counts.

    ``count(low, high, cells)`` gives a histogram of the keys in equal steps. Cells
    that hold more than a quarter of a part are counted again in finer steps until they
    do not, or are a single key; so a part differs from its share by a quarter of
    it at most, but for keys that hold more rows alone."""
    if parts < 1:
        raise ValueError("parts must be >= 1")
    todo, done = sorted(c for c in count(low, high, cells) if c.rows), []
    most = sum(c.rows for c in todo) / parts / 4
    while todo:
        cell = todo.pop()
        if cell.rows > most and cell.high > cell.low:
            todo += [c for c in count(cell.low, cell.high, cells) if c.rows]
        else:
            done.append(cell)
    done.sort()
    total, before, bounds = sum(c.rows for c in done), 0, []
    for cell in done:  # a bound goes before the cell whose beginning is nearest to the next share
        share = total * (len(bounds) + 1) / parts
        if bounds and cell.low == bounds[-1]:
            pass
        elif before and len(bounds) < parts - 1 and abs(before - share) <= abs(before + cell.rows - share):
            bounds.append(cell.low)
        before += cell.rows
    return tuple(bounds)


def histogram_query(table: str, column: str, low: int, high: int, cells: int) -> tuple[str, int]:
    """SQL that counts the keys of each step of the returned width."""
    width = -(-(high - low + 1) // cells)
    cell = f"FLOOR(({column} - ({low})) * 1.0 / {width})"
    return f"SELECT {cell} AS cell, COUNT(*) AS n FROM {table} WHERE {column} >= {low} AND {column} <= {high} GROUP BY {cell}", width


def split_depths(spark: SparkSession, source: JdbcSource, table: str, column: str,
                 num_partitions: int) -> EquiDepthSplit | None:
    """An :class:`EquiDepthSplit` of an integer ``column`` by histograms that the
    database computes (``CELLS`` rows a query); None if it has no value."""
    whole = split_bounds(spark, source, table, column, num_partitions)
    if whole is None:
        return None

    def count(low: int, high: int, cells: int) -> list[Cell]:
        query, width = histogram_query(table, column, low, high, cells)
        found = spark.read.format("jdbc").options(**source.options()).option("query", query).load().collect()
        return [Cell(low + int(cell) * width, min(high, low + (int(cell) + 1) * width - 1), int(n)) for cell, n in found]

    return EquiDepthSplit(column, equi_depth_bounds(count, int(whole.lower), int(whole.upper), num_partitions))


def read_table(spark: SparkSession, source: JdbcSource, table: str,
               split: Split | ModuloSplit | EquiDepthSplit | None = None) -> DataFrame:
    """Lazy DataFrame over ``table``; filters and projections are pushed
    into the generated SELECT by Spark's JDBC source."""
    if isinstance(split, (ModuloSplit, EquiDepthSplit)):
        opts = source.options()
        url = opts.pop("url")
        return spark.read.jdbc(url, table, predicates=split.predicates(), properties=opts)
    reader = spark.read.format("jdbc").options(**source.options()).option("dbtable", table)
    if split is not None:
        reader = reader.options(**split.options())
    return reader.load()


def split_bounds(spark: SparkSession, source: JdbcSource, table: str, column: str,
                 num_partitions: int) -> Split | None:
    """Ask the database for min/max of ``column`` (one aggregate row, computed
    by the database) and build a :class:`Split` from them; None (read
    unsplit) when the table has no non-NULL value to split on."""
    row = (
        spark.read.format("jdbc").options(**source.options())
        .option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
        .load().first()
    )
    lo, hi = (row[0], row[1]) if row is not None else (None, None)
    if lo is None or hi is None:
        return None
    return Split(column, lo, hi, num_partitions)
