"""Hand-made cases: one per semantic decision the driver's data cannot reach."""

from __future__ import annotations

from tarmac.plans import questions as q
from tarmac.plans.mart import append_answer, run_mart
from tests.conftest import flight, make_tables, money, responses


def _tickets(book, names, start=1, pid=None, contact="c"):
    return [(book, start + i, pid or f"{book}-{i}", n, contact) for i, n in enumerate(names)]


def test_q03_counts_groups_of_repeated_names(spark):
    t = make_tables(spark, tickets=_tickets("X", ["A", "A", "B"], 1) + _tickets("Y", ["C", "C", "C"], 10)
                    + _tickets("Z", ["D"], 20))
    assert responses(q.q03_repeat_names_in_max_bookings(t)) == ["2"]


def test_q03_two_repeats_in_one_booking_count_as_two(spark):
    t = make_tables(spark, tickets=_tickets("X", ["A", "A", "B", "B"]) + _tickets("Y", ["C"], 10))
    assert responses(q.q03_repeat_names_in_max_bookings(t)) == ["2"]


def test_q05_leg_without_flight(spark):
    t = make_tables(
        spark,
        tickets=_tickets("X", ["A"]),
        ticket_flights=[(1, 100, money("1.00")), (1, 101, money("1.00")), (1, 999, money("1.00"))],
        flights_v=[flight(100), flight(101)],
    )
    assert responses(q.q05_max_flights_per_booking(t)) == ["2"]
    assert responses(q.q05_max_legs_no_flight_check(t)) == ["3"]


def test_q01_q05_empty_input_gives_no_row(spark):
    t = make_tables(spark)
    assert responses(q.q01_max_people_per_booking(t)) == []
    assert responses(q.q05_max_flights_per_booking(t)) == []
    assert responses(q.q02_bookings_above_avg_size(t)) == ["0"]
    assert responses(q.q03_repeat_names_in_max_bookings(t)) == ["0"]


def test_q08_null_sum_never_wins_and_ties_kept(spark):
    t = make_tables(
        spark,
        tickets=[("B1", 1, "p1", "N1", "c1"), ("B2", 2, "p2", "N2", "c2"),
                 ("B3", 3, "p3", "N3", "c3"), ("B4", 4, "p4", "N4", "c4")],
        ticket_flights=[(1, 100, None), (2, 100, money("5.00")), (3, 100, money("2.50")),
                        (3, 101, money("2.50")), (4, 100, money("7.00"))],
        flights_v=[flight(100), flight(101)],
    )
    assert responses(q.q08_min_spend_passengers(t)) == ["p2|N2|c2|5.00", "p3|N3|c3|5.00"]


def test_q08_cancelled_flights_do_not_count(spark):
    t = make_tables(
        spark,
        tickets=[("B1", 1, "p1", "N1", "c1"), ("B2", 2, "p2", "N2", "c2")],
        ticket_flights=[(1, 100, money("1.00")), (2, 101, money("3.00")), (2, 102, money("9.00"))],
        flights_v=[flight(100, status="Cancelled"), flight(101), flight(102, status="Scheduled")],
    )
    assert responses(q.q08_min_spend_passengers(t)) == ["p2|N2|c2|12.00"]


def test_q09_null_times_never_win_and_long_total(spark):
    # 363,785 s = 101 h 3 min 5 s, spread over legs longer than a day.
    t = make_tables(
        spark,
        tickets=[("B1", 1, "p1", "N1", "c1"), ("B2", 2, "p2", "N2", "c2")],
        ticket_flights=[(1, 100, money("1")), (1, 101, money("1")), (2, 102, money("1"))],
        flights_v=[
            flight(100, ad="2016-09-01 00:00:00", aa="2016-09-04 00:00:00"),   # 259,200 s
            flight(101, ad="2016-09-10 00:00:00", aa="2016-09-11 05:03:05"),   # 104,585 s
            flight(102, ad="2016-09-01 00:00:00", aa=None),
        ],
    )
    assert responses(q.q09_max_airtime_passengers(t)) == ["p1|N1|c1|101:03:05"]


def test_q09_only_null_times_gives_no_row(spark):
    t = make_tables(
        spark,
        tickets=[("B2", 2, "p2", "N2", "c2")],
        ticket_flights=[(2, 102, money("1"))],
        flights_v=[flight(102, ad="2016-09-01 00:00:00", aa=None)],
    )
    assert responses(q.q09_max_airtime_passengers(t)) == []


def test_null_contact_q04_null_q08_empty_part(spark):
    t = make_tables(
        spark,
        tickets=[("B1", 1, "p1", "N1", None), ("B1", 2, "p2", "N2", "c2"), ("B1", 3, "p3", "N3", "c3")],
        ticket_flights=[(1, 100, money("1.00"))],
        flights_v=[flight(100)],
    )
    assert responses(q.q04_contacts_bookings_of_three(t)) == ["B1|p2|N2|c2", "B1|p3|N3|c3", None]
    assert responses(q.q08_min_spend_passengers(t)) == ["p1|N1||1.00"]


def test_q16_deviation_below_one_minute_is_zero(spark):
    t = make_tables(spark, flights_v=[
        flight(1, sd="2016-09-01 10:00:00", sa="2016-09-01 11:00:00",
               ad="2016-09-01 10:05:00", aa="2016-09-01 11:05:30"),
    ])
    assert responses(q.q16_schedule_deviation_minutes(t)) == ["0"]


def test_q16_sums_before_truncating(spark):
    # -30 s and -45 s: |-75| div 60 = 1 (per-flight truncation would give 0).
    t = make_tables(spark, flights_v=[
        flight(1, sd="2016-09-01 10:00:00", sa="2016-09-01 11:00:00",
               ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:30"),
        flight(2, sd="2016-09-01 10:00:00", sa="2016-09-01 11:00:00",
               ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:45"),
    ])
    assert responses(q.q16_schedule_deviation_minutes(t)) == ["1"]


def test_q19_day_boundary_and_shifted_form(spark):
    t = make_tables(spark, flights_v=[
        flight(1, ad="2016-09-14 01:00:00", aa="2016-09-14 02:00:00"),
        flight(2, ad="2016-09-15 12:00:00", aa="2016-09-15 13:00:00"),
        flight(3, ad="2016-09-15 13:00:00", aa="2016-09-15 14:00:00"),
        flight(4, status="Scheduled"),  # unknown departure: not a day
    ])
    assert responses(q.q19_quietest_days(t)) == ["2016-09-14"]
    assert responses(q.q19_quietest_days_shifted(t)) == ["2016-09-13"]


def test_q20_integer_division(spark):
    rows = [flight(i, dep="Москва", status="Departed", ad=f"2016-09-{1 + i % 30:02d} 10:00:00")
            for i in range(61)]
    rows.append(flight(99, dep="Москва", ad="2016-10-01 10:00:00", aa="2016-10-01 11:00:00"))
    t = make_tables(spark, flights_v=rows)
    assert responses(q.q20_avg_departures_per_day(t)) == ["2"]


def test_q12_reverse_only_pair_is_unconnected(spark):
    t = make_tables(
        spark,
        airports=[(1, "A"), (2, "B"), (3, "B"), (4, "C")],
        flights_v=[flight(1, dep="B", arr="A"), flight(2, dep="A", arr="C")],
    )
    assert responses(q.q12_unconnected_city_pairs(t)) == ["A|B", "B|C"]


def test_q21_fifth_place_tie_and_strict_threshold(spark):
    def hours(fid, city, seconds):
        from datetime import datetime, timedelta
        start = datetime(2016, 9, 1, 0, 0, 0)
        return flight(fid, dep=city, ad=start.isoformat(sep=" "),
                      aa=(start + timedelta(seconds=seconds)).isoformat(sep=" "))

    rows = [hours(1, "C1", 20000), hours(2, "C2", 19000), hours(3, "C3", 18000),
            hours(4, "C4", 17000), hours(5, "C6", 15000), hours(6, "C5", 15000),
            hours(7, "C7", 10800),                       # exactly three hours: excluded
            hours(8, "C8", 90000)]                       # a 25 h flight counts whole
    t = make_tables(spark, flights_v=rows)
    assert responses(q.q21_top5_long_flight_cities(t)) == ["C1", "C2", "C3", "C4", "C8"]
    rows = rows[:-1]
    t = make_tables(spark, flights_v=rows)
    assert responses(q.q21_top5_long_flight_cities(t)) == ["C1", "C2", "C3", "C4", "C5"]


def test_non_ascii_city_parameters(spark):
    t = make_tables(
        spark,
        airports=[(1, "Москва"), (2, "Санкт-Петербург"), (3, "Казань")],
        flights_v=[
            flight(1, dep="Москва", arr="Казань", status="Departed", ad="2016-09-02 10:00:00"),
            flight(2, dep="Санкт-Петербург", arr="Москва", ad="2016-09-13 09:00:00",
                   aa="2016-09-13 10:00:00"),
        ],
    )
    assert responses(q.q13_unreachable_from_city(t)) == ["Санкт-Петербург"]
    assert responses(q.q17_destinations_on_day(t)) == ["Москва"]
    assert responses(q.q20_avg_departures_per_day(t)) == ["0"]


def test_q13_unknown_origin_gives_nothing(spark):
    t = make_tables(spark, airports=[(1, "A"), (2, "B")], flights_v=[flight(1, dep="A", arr="B")])
    assert responses(q.q13_unreachable_from_city(t, origin="Z")) == []
    assert responses(q.q13_unreachable_from_city(t, origin="B")) == ["A"]


def test_q14_q15_models_with_ties(spark):
    t = make_tables(
        spark,
        tickets=[("B", 1, "p", "n", "c")],
        ticket_flights=[(1, 1, money("1")), (1, 2, money("1")), (1, 3, money("1")), (1, 3, money("1"))],
        flights_v=[flight(1, code="X"), flight(2, code="Y"), flight(3, code="Z", status="Departed")],
        aircrafts=[("X", "Model X"), ("Y", "Model Y"), ("Z", "Model Z")],
    )
    assert responses(q.q14_model_most_flights(t)) == ["Model X", "Model Y"]
    assert responses(q.q15_model_most_passengers(t)) == ["Model X", "Model Y"]


def test_q18_null_revenue_never_wins(spark):
    t = make_tables(
        spark,
        ticket_flights=[(1, 1, None), (1, 2, money("3.00")), (2, 2, money("4.00")), (1, 3, money("9.00"))],
        flights_v=[flight(1), flight(2), flight(3, status="Cancelled")],
    )
    assert responses(q.q18_top_revenue_flights(t)) == ["2"]


def test_mart_second_run_same_rows(spark, tmp_path):
    t = make_tables(
        spark,
        tickets=_tickets("X", ["A", "A", "B"]),
        ticket_flights=[(1, 1, money("2.00"))],
        flights_v=[flight(1, ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:00")],
        airports=[(1, "A"), (2, "B")],
        aircrafts=[("C1", "M")],
    )
    path = str(tmp_path / "results")
    first = run_mart(spark, t, "fixture_results", path).count()
    second = run_mart(spark, t, "fixture_results", path).count()
    assert first == second > 0
    assert spark.table("fixture_results").schema.simpleString() == "struct<id:int,response:string>"


def test_append_one_answer_after_the_mart(spark, tmp_path):
    t = make_tables(
        spark,
        tickets=_tickets("X", ["A", "A", "B"]),
        ticket_flights=[(1, 1, money("2.00"))],
        flights_v=[flight(1, ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:00")],
        airports=[(1, "A"), (2, "A")],
        aircrafts=[("C1", "M")],
    )
    path = str(tmp_path / "results")
    base = run_mart(spark, t, "append_results", path).count()
    after = append_answer(spark, q.q10_cities_multi_airport, t, "append_results", path)
    assert after.count() == base + 1
    assert after.where("id = 10").count() == 2
