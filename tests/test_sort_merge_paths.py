"""The join-heavy keys with every broadcast disabled (estimate-based and
runtime), i.e. the sort-merge plans a large cluster runs, against the
oracle SQL."""

from __future__ import annotations

import pytest

from tests.conftest import SF01
from tests.oracle_compare import compare

KEYS = [
    "q03_repeat_names_in_max_bookings", "q04_contacts_bookings_of_three", "q05_max_flights_per_booking",
    "q08_min_spend_passengers", "q09_max_airtime_passengers", "q12_unconnected_city_pairs",
    "q13_unreachable_from_city", "q15_model_most_passengers", "q18_top_revenue_flights", "mart_results",
]


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_sort_merge_plans_match_oracle(no_broadcast):
    rep = compare(no_broadcast, SF01, KEYS, verbose=False)
    assert all(v["ok"] for v in rep.values()), {k: v for k, v in rep.items() if not v["ok"]}
