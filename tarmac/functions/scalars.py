"""Scalar column helpers.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def span_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (BIGINT, NULL if either is NULL).

    Works for TIMESTAMP and TIMESTAMP_NTZ alike; sub-second parts are
    truncated, so sums of spans are exact integers (no double drift).
    """
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def int_div(column: str, divisor: int) -> Column:
    """Integral division truncating toward zero (SQL ``div``), BIGINT result.

    ``column`` names a column; PySpark's ``/`` would yield a DOUBLE.
    """
    return F.expr(f"`{column}` div {int(divisor)}")


def hms(seconds: str) -> Column:
    """Format a count of seconds as ``hh:mm:ss``; hours are at least two
    digits and grow past 99 (363785 s -> ``101:03:05``)."""
    s = F.col(seconds)
    return F.format_string(
        "%02d:%02d:%02d",
        int_div(seconds, 3600),
        F.expr(f"(`{seconds}` % 3600) div 60"),
        s % 60,
    )


def day(ts: Column | str) -> Column:
    """Calendar day of a timestamp in the session time zone (DATE)."""
    return _col(ts).cast("date")


def shifted_day(ts: Column | str, zone: str) -> Column:
    """Day after reading ``ts`` as wall-clock time in ``zone`` and moving it
    to UTC wall-clock time (``to_utc_timestamp`` semantics). For
    TIMESTAMP_NTZ input the result does not depend on the session zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(ts)).cast("date")


def concat_strict(*parts: Column | str) -> Column:
    """``a || b || ...``: NULL as soon as one part is NULL."""
    return F.concat(*[_col(p) for p in parts])


def concat_empty(*parts: Column | str) -> Column:
    """``concat(a, b, ...)`` with NULL parts taken as empty strings; literal
    separators stay in place (unlike ``concat_ws``, which drops them)."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def duration_seconds(text: Column | str) -> Column:
    """Parse an ``H..H:mm:ss[.f..f]`` duration to whole seconds (BIGINT).

    Hours may have any number of digits (a time-of-day parser would reject more
    than 23) and a fraction of a second is dropped, as :func:`span_seconds` does;
    malformed input, or hours beyond BIGINT, give NULL rather than an error.
    """
    t = _col(text)
    part = [F.regexp_extract(t, r"^([0-9]+):([0-5]?[0-9]):([0-5]?[0-9])(?:\.[0-9]*)?$", i).try_cast("bigint") for i in (1, 2, 3)]
    hours = F.try_multiply(part[0], F.lit(3600).cast("bigint"))
    return F.try_add(hours, part[1] * 60 + part[2])
