"""PostgreSQL's spellings for spans, as SQL-defined temporary functions.

Each body is one Spark SQL expression, which Catalyst inlines into the query
that calls it; nothing is a Python function. ``EXTRACT(EPOCH FROM x)`` has no
field of that name in Spark, so it is ``epoch(x)``, and ``to_char(x,
'hh24:mi:ss')`` of an interval is ``to_char_span(x)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# name: (parameters, result, body)
FUNCTIONS = {
    "age": ("later TIMESTAMP_NTZ, earlier TIMESTAMP_NTZ", "INTERVAL DAY TO SECOND", "later - earlier"),
    # whole seconds, as the questions count them
    "epoch": ("span INTERVAL DAY TO SECOND", "BIGINT",
              "extract(DAY FROM span) * 86400L + extract(HOUR FROM span) * 3600 + extract(MINUTE FROM span) * 60 "
              "+ CAST(extract(SECOND FROM span) AS BIGINT)"),
    "seconds_span": ("seconds BIGINT", "INTERVAL DAY TO SECOND", "make_dt_interval(0, 0, 0, seconds)"),
    # hours grow past two digits instead of turning into days
    "to_char_span": ("span INTERVAL DAY TO SECOND", "STRING",
                     "CASE WHEN span IS NOT NULL THEN format_string('%02d:%02d:%02d', extract(DAY FROM span) * 24L "
                     "+ extract(HOUR FROM span), extract(MINUTE FROM span), CAST(extract(SECOND FROM span) AS BIGINT)) END"),
    "span": ("text STRING", "INTERVAL DAY TO SECOND",
             "make_dt_interval(0, CAST(split_part(text, ':', 1) AS INT), CAST(split_part(text, ':', 2) AS INT), "
             "CAST(split_part(text, ':', 3) AS DECIMAL(18, 6)))"),
}


def register(spark: SparkSession) -> list[str]:
    """Define the functions in the session and return their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
