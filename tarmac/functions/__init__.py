from tarmac.functions.scalars import (
    concat_empty,
    concat_strict,
    day,
    duration_seconds,
    hms,
    int_div,
    shifted_day,
    span_seconds,
)

__all__ = [
    "concat_empty",
    "concat_strict",
    "day",
    "duration_seconds",
    "hms",
    "int_div",
    "shifted_day",
    "span_seconds",
]
