"""Every query key against its DuckDB oracle on the driver's tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tarmac.plans import oracle, registry
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare

KEYS = list(registry.queries())


def test_every_key_has_oracle_sql():
    assert set(oracle.oracle_sql()) == set(registry.queries())
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle_sf01(spark, key):
    rep = compare(spark, SF01, [key], verbose=False)[key]
    assert rep["ok"], rep


def test_all_keys_match_oracle_sf0001(spark):
    rep = compare(spark, SF001, KEYS, verbose=False)
    assert all(v["ok"] for v in rep.values()), {k: v for k, v in rep.items() if not v["ok"]}


# Answers at sf0.01 recorded by the survey's independent probe.
PROBE = {
    "q01_max_people_per_booking": ["9"],
    "q02_bookings_above_avg_size": ["4367"],
    "q03_repeat_names_in_max_bookings": ["3"],
    "q05_max_flights_per_booking": ["38"],
    "q05_max_legs_no_flight_check": ["39"],
    "q06_max_flights_per_ticket": ["13"],
    "q07_max_flights_per_passenger": ["40"],
    "q13_unreachable_from_city": ["NATION_14"],
    "q14_model_most_flights": ["Model 2"],
    "q15_model_most_passengers": ["Model 2"],
    "q16_schedule_deviation_minutes": ["1346"],
    "q17_destinations_on_day": ["NATION_8"],
    "q18_top_revenue_flights": ["706"],
    "q19_quietest_days": ["2016-08-29"],
    "q19_quietest_days_shifted": ["2016-07-31"],
    "q20_avg_departures_per_day": ["1"],
    "q11_fewest_direct_cities_by_arrival": ["NATION_15"],
    "q11_fewest_departures": ["NATION_14"],
}


@pytest.mark.parametrize("key", sorted(PROBE))
def test_probe_answers(spark, key):
    got = sorted(r["response"] for r in entry.queries()[key](spark, SF01).collect())
    assert got == PROBE[key]


def test_probe_counts_and_rows(spark):
    q = entry.queries()
    assert q["q04_contacts_bookings_of_three"](spark, SF01).count() == 3795
    assert q["q10_cities_multi_airport"](spark, SF01).count() == 23
    assert q["q11_fewest_direct_cities"](spark, SF01).count() == 7
    assert q["q12_unconnected_city_pairs"](spark, SF01).count() == 13
    q08 = [r["response"] for r in q["q08_min_spend_passengers"](spark, SF01).collect()]
    assert len(q08) == 1 and q08[0].startswith("001036-1|") and q08[0].endswith("|1346.26")
    q09 = [r["response"] for r in q["q09_max_airtime_passengers"](spark, SF01).collect()]
    assert len(q09) == 1 and q09[0].startswith("000765-4|")
    q21 = [r["response"] for r in q["q21_top5_long_flight_cities"](spark, SF01).collect()]
    assert sorted(q21) == sorted(["NATION_21", "NATION_13", "NATION_24", "NATION_11", "NATION_7"])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "response"]
    assert df.count() >= 1
