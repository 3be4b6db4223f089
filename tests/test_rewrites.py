"""The aggregate-first rewrites (per-ticket / per-flight facts, roll-ups,
semi-join extremes) against the flat SQL of the oracle, on random tables
with the awkward cases: repeated ticket rows, legs of unknown flights,
NULL amounts, NULL and cancelled statuses, NULL times, shared passengers."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest

from tarmac.plans import questions as q
from tarmac.plans.oracle import BODIES
from tests.conftest import make_tables
from tests.oracle_compare import _canon

KEYS = [
    "q01_max_people_per_booking", "q02_bookings_above_avg_size", "q03_repeat_names_in_max_bookings",
    "q04_contacts_bookings_of_three", "q05_max_flights_per_booking", "q05_max_legs_no_flight_check", "q06_max_flights_per_ticket",
    "q07_max_flights_per_passenger", "q08_min_spend_passengers", "q09_max_airtime_passengers",
    "q14_model_most_flights", "q15_model_most_passengers", "q18_top_revenue_flights",
]


def _random_tables(spark, seed):
    rnd = random.Random(seed)
    passengers = [(f"p{i}", f"N{i % 3}", rnd.choice([None, "c1", "c2"])) for i in range(6)]
    tickets = []
    for no in range(1, 16):
        pid, name, contact = rnd.choice(passengers)
        booking = None if rnd.random() < 0.15 else f"B{rnd.randrange(5)}"
        row = (booking, no, pid, None if rnd.random() < 0.1 else name, contact)
        tickets.append(row)
        if rnd.random() < 0.2:
            tickets.append(row)  # repeated ticket row
    statuses = ["Arrived", "Arrived", "Departed", "Cancelled", "Scheduled", None]
    flights = []
    start = dt.datetime(2016, 9, 1)
    for fid in range(1, 9):
        status = rnd.choice(statuses)
        dep = start + dt.timedelta(hours=rnd.randrange(100))
        arr = dep + dt.timedelta(minutes=rnd.randrange(30, 900)) if rnd.random() < 0.85 else None
        ad = dep if status in ("Arrived", "Departed") else None
        aa = arr if status == "Arrived" else None
        flights.append((fid, "A", "B", rnd.choice(["X", "Y", "Z"]), status, dep,
                        dep + dt.timedelta(hours=2), ad, aa))
    legs = []
    for _ in range(40):
        amount = None if rnd.random() < 0.15 else Decimal(rnd.randrange(100, 99999)) / 100
        legs.append((rnd.randrange(1, 18), rnd.randrange(1, 11), amount))  # some unknown tickets/flights
    aircrafts = [("X", "Model X"), ("Y", "Model Y"), ("Z", "Model Z")]
    return make_tables(spark, tickets=tickets, ticket_flights=legs, flights_v=flights, aircrafts=aircrafts)


@pytest.mark.parametrize("seed", range(8))
def test_rewrites_match_flat_sql(spark, seed):
    t = _random_tables(spark, seed)
    con = duckdb.connect()
    for name in ("tickets", "ticket_flights", "flights_v", "flights", "aircrafts"):
        con.register(f"{name}_pdf", getattr(t, name).toPandas())  # tiny test tables
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_pdf")
    for key in KEYS:
        df = getattr(q, key)(t)
        rel = con.sql(BODIES[key])
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
        want = _canon(rel.columns, rel.fetchall())
        assert got == want, (seed, key, got, want)


def test_largest_group_without_a_booking_counts_nothing(spark):
    """The largest group has a NULL book_ref: it sets the maximum, but its rows
    are in no booking (``book_ref IN (...)`` drops NULL)."""
    rows = [(None, i, "p", "SAME", None) for i in range(4)] + [("B", 9, "p", "X", None), ("B", 10, "p", "X", None)]
    t = make_tables(spark, tickets=rows)
    assert [r.response for r in q.q03_repeat_names_in_max_bookings(t).collect()] == ["0"]


def test_spend_reads_flights_and_legs_read_the_view(spark):
    """A flight that only ``flights`` lists counts for q08 but not for q05-q07."""
    from tests.conftest import flight

    t = make_tables(
        spark, tickets=[("B1", 1, "p1", "N1", "c"), ("B2", 2, "p2", "N2", "c")],
        ticket_flights=[(1, 100, Decimal("10.00")), (2, 100, Decimal("5.00")), (2, 101, Decimal("45.00"))],
        flights_v=[flight(100)])
    t = t.replace(flights=spark.createDataFrame([(100, "Arrived"), (101, "Scheduled")], "flight_id long, status string"))
    assert [r.response for r in q.q08_min_spend_passengers(t).collect()] == ["p1|N1|c|10.00"]
    assert [r.response for r in q.q05_max_flights_per_booking(t).collect()] == ["1"]


def test_rows_that_differ_under_one_ticket_count_each(spark):
    """As in the flat join: each row of a repeated ticket_no takes all its legs."""
    import duckdb

    from tarmac.plans.oracle import BODIES
    from tests.conftest import flight

    t = make_tables(spark, tickets=[("B1", 1, "p1", "N1", "c"), ("B1", 1, "p2", "N1", "c"), ("B1", 1, "p2", "N1", "c"), ("B2", 1, "p1", None, "c"),
                                    ("B2", 2, "p1", "N1", "c"), (None, None, "p3", "N", "c")],
                    ticket_flights=[(1, 100, Decimal("10.00")), (1, 101, Decimal("1.00")), (2, 100, Decimal("4.00")), (None, 100, Decimal("9.00"))],
                    flights_v=[flight(100, ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:00"), flight(101, ad="2016-09-01 10:00:00", aa="2016-09-01 10:30:00")])
    con = duckdb.connect()
    for name in ("tickets", "ticket_flights", "flights_v", "flights"):
        con.register(f"{name}_pdf", getattr(t, name).toPandas())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_pdf")
    for key in ("q05_max_flights_per_booking", "q05_max_legs_no_flight_check", "q06_max_flights_per_ticket", "q07_max_flights_per_passenger",
                "q08_min_spend_passengers", "q09_max_airtime_passengers"):
        got = [tuple(r) for r in getattr(q, key)(t).collect()]
        assert _canon(["id", "response"], got) == _canon(["id", "response"], con.sql(BODIES[key]).fetchall()), key


def test_grouping_sets_like_single_groupings(spark):
    """The totals of all sets equal each question's own roll-up, NULL keys too."""
    from tests.conftest import flight

    t = make_tables(spark, tickets=[("B1", 1, "p1", "N1", "c"), ("B1", 2, None, "N1", None), (None, 3, "p1", None, "c"), (None, 3, "p1", None, "c"), ("B2", 9, "p9", "N9", "c")],
                    ticket_flights=[(1, 100, Decimal("10.00")), (2, 100, Decimal("4.00")), (3, 100, None), (3, 100, Decimal("2.00"))],
                    flights_v=[flight(100, ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:00")])
    stored = t.replace(derived={"ticket_totals": q.ticket_totals(t)})
    for name in q.TICKET_SETS:
        alone = q.totals_by(t, name, legs="legs", spend="spend", airtime="airtime")
        assert sorted(map(str, q.totals_by(stored, name, legs="legs", spend="spend", airtime="airtime").collect())) == sorted(map(str, alone.collect()))
    plan = q.ticket_totals(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
