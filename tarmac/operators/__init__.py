from tarmac.operators.ordered import By, band_join, inequality_join, ranked, top_ranked
from tarmac.operators.relational import (
    COPIES,
    answer,
    dense_index,
    except_rows,
    extreme_rows,
    keys_with_size,
    missing_pairs,
    per_flight,
    per_ticket,
    roll_up,
    splittable,
    top_value,
    unreached_from,
    with_ticket,
)

__all__ = [
    "COPIES",
    "By",
    "answer",
    "band_join",
    "dense_index",
    "except_rows",
    "extreme_rows",
    "inequality_join",
    "keys_with_size",
    "missing_pairs",
    "per_flight",
    "per_ticket",
    "ranked",
    "roll_up",
    "splittable",
    "top_ranked",
    "top_value",
    "unreached_from",
    "with_ticket",
]
