"""The star-schema binding: row counts from FIXTURES.md and guard rails."""

from __future__ import annotations

import pytest

from tarmac.sources.binding import bind_flights_v, from_star_schema
from tests.conftest import SF001, SF01

# Rows after binding (FIXTURES.md, section B).
EXPECTED = {
    SF001: {"tickets": 1500, "ticket_flights": 6000, "flights": 200, "flights_v": 193, "airports": 10, "aircrafts": 25,
            "routes": 193},
    SF01: {"tickets": 15000, "ticket_flights": 60000, "flights": 2000, "flights_v": 1925, "airports": 100, "aircrafts": 25,
           "routes": 1809},
}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_binding_row_counts(spark, sf):
    t = from_star_schema(spark, sf)
    for name, rows in EXPECTED[sf].items():
        assert getattr(t, name).count() == rows, name


def test_duplicate_nation_key_raises(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    with pytest.raises(Exception, match="nation key is not unique"):
        bind_flights_v(part, nation.unionByName(nation.limit(1))).count()


def test_catalog_prefix_and_sql_views(spark):
    from tarmac.plans import questions as q
    from tarmac.sources.tables import from_catalog

    t = from_star_schema(spark, SF001)
    views = t.register_views(prefix="bk_")
    assert views[0] == "bk_tickets" and len(views) == 8
    again = from_catalog(spark, prefix="bk_")
    assert sorted(q.q10_cities_multi_airport(again).collect()) == sorted(q.q10_cities_multi_airport(t).collect())
    sql = spark.sql("SELECT 1 AS id, CAST(count(*) AS STRING) AS response FROM bk_tickets "
                    "GROUP BY book_ref ORDER BY count(*) DESC LIMIT 1")
    assert sql.collect() == q.q01_max_people_per_booking(t).collect()
