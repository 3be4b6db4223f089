from tarmac.sources.binding import from_star_schema
from tarmac.sources.tables import (
    CONTRACT,
    DAY_PARTITION_COLUMN,
    BookingTables,
    from_catalog,
    from_parquet,
)

__all__ = [
    "CONTRACT",
    "DAY_PARTITION_COLUMN",
    "BookingTables",
    "from_catalog",
    "from_parquet",
    "from_star_schema",
]
