"""Extract-load copies and the JDBC reader configuration.

No database is started here, so the JDBC reader itself is not exercised
against a live connection; the copies are fed from the bookings views.
"""

from __future__ import annotations

import os

import pytest

from tarmac.plans.extract_load import copy_by_day, copy_table
from tarmac.sources.binding import from_star_schema
from tarmac.sources.jdbc import JdbcSource, ModuloSplit, Split
from tests.conftest import SF001, flight, make_tables


def test_copy_table_round_trip(spark, tmp_path):
    seats = from_star_schema(spark, SF001).seats
    copy = copy_table(spark, seats, "test_seats", str(tmp_path / "seats"))
    assert sorted(copy.collect()) == sorted(seats.collect())
    again = copy_table(spark, seats, "test_seats", str(tmp_path / "seats"))
    assert again.count() == seats.count()  # overwrite, not append


def test_copy_by_day_layout_and_null_partition(spark, tmp_path):
    t = make_tables(spark, flights_v=[
        flight(1, ad="2016-09-13 23:59:00", aa="2016-09-14 01:00:00"),
        flight(2, ad="2016-09-14 00:00:00", aa="2016-09-14 01:00:00"),
        flight(3, status="Scheduled"),
    ])
    path = str(tmp_path / "fv")
    copy = copy_by_day(spark, t.flights_v, "actual_departure", "test_fv_days", path)
    dirs = sorted(d for d in os.listdir(path) if not d.startswith(("_", ".")))
    assert dirs == ["actual_departure_date=2016-09-13", "actual_departure_date=2016-09-14",
                    "actual_departure_date=__HIVE_DEFAULT_PARTITION__"]
    assert copy.count() == 3
    assert copy.where("actual_departure_date IS NULL").count() == 1


def test_jdbc_options():
    src = JdbcSource("jdbc:postgresql://db/demo", user="u", password="p", driver="org.postgresql.Driver")
    opts = src.options()
    assert opts["url"] == "jdbc:postgresql://db/demo" and opts["user"] == "u"
    assert opts["driver"] == "org.postgresql.Driver" and opts["fetchsize"] == "10000"
    split = Split("flight_id", 1, 214867, 32).options()
    assert split == {"partitionColumn": "flight_id", "lowerBound": "1", "upperBound": "214867",
                     "numPartitions": "32"}
    with pytest.raises(ValueError):
        Split("x", 0, 1, 0).options()
    preds = ModuloSplit("ticket_no", 3).predicates()
    assert preds == ["MOD(ticket_no, 3) = 0", "MOD(ticket_no, 3) IN (1, -2)", "MOD(ticket_no, 3) IN (2, -1)",
                     "ticket_no IS NULL"]
    # every integer key falls in exactly one class, under both sign conventions of MOD
    import math
    for key in range(-10, 11):
        for mod in (lambda a, b: int(math.fmod(a, b)), lambda a, b: a % b):
            r = mod(key, 3)
            hits = [p for p in preds[:-1] if (r == 0 and p.endswith("= 0"))
                    or (r != 0 and f"({r}," in p or f", {r})" in p)]
            assert len(hits) == 1, (key, r)


def test_calc_job_from_parquet_root_matches_registry(spark, tmp_path):
    from tarmac.jobs import run_calc
    from tarmac.plans.registry import BOUND_PARAMS, bound_mart
    from tarmac.sources.tables import TABLES, from_parquet

    views = from_star_schema(spark, SF001)
    root = tmp_path / "bookings"
    for name in TABLES:
        getattr(views, name).write.parquet(str(root / name))
    stored = run_calc(spark, from_parquet(spark, str(root)), "job_results",
                      str(tmp_path / "results"), BOUND_PARAMS)
    assert sorted(stored.collect()) == sorted(bound_mart(spark, SF001).collect())


def test_job_arguments():
    from tarmac.jobs import _parse

    a = _parse(["extract-load", "--url", "jdbc:x", "--target-root", "/t", "--split", "flights_v=flight_id",
                "--partitions", "8"])
    assert a.split == ["flights_v=flight_id"] and a.partitions == 8
    c = _parse(["calc", "--catalog-db", "mart", "--param", "q13_unreachable_from_city.origin=Казань"])
    assert c.catalog_db == "mart" and c.table == "results"
    from tarmac.jobs import _params
    assert _params(c.param) == {"q13_unreachable_from_city": {"origin": "Казань"}}
    assert _params(["q21_top5_long_flight_cities.top=3"]) == {"q21_top5_long_flight_cities": {"top": 3}}
    with pytest.raises(ValueError):
        _params(["q21_top5_long_flight_cities.nope=3"])


def test_calc_cli_reads_prefixed_catalog_tables_without_seats(spark, tmp_path):
    from tarmac.jobs import main
    from tarmac.plans.registry import BOUND_PARAMS, bound_mart
    from tarmac.sources.tables import TABLES

    views = from_star_schema(spark, SF001)
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_src LOCATION '%s'" % (tmp_path / "db"))
    for name in TABLES:
        if name != "seats":
            getattr(views, name).write.mode("overwrite").option("path", str(tmp_path / name)).saveAsTable(f"cli_src.bookings_{name}")
    args = ["calc", "--catalog-db", "cli_src", "--prefix", "bookings_", "--table", "cli_prefixed", "--path", str(tmp_path / "out")]
    for question, kwargs in BOUND_PARAMS.items():
        args += [f"--param={question}.{k}={v}" for k, v in kwargs.items()]
    main(args)
    assert sorted(spark.table("cli_prefixed").collect()) == sorted(bound_mart(spark, SF001).collect())
    spark.sql("DROP DATABASE cli_src CASCADE")


def test_large_tables_need_a_split():
    from tarmac.jobs import _parse

    base = ["extract-load", "--url", "jdbc:x", "--target-root", "/t"]
    with pytest.raises(SystemExit):
        _parse(base)
    with pytest.raises(SystemExit):
        _parse([*base, "--split", "flights_v=flight_id"])
    assert _parse([*base, "--one-task", "flights_v"]).one_task == ["flights_v"]


def test_password_is_not_shown():
    assert "secret" not in repr(JdbcSource("jdbc:x", "u", "secret"))


def test_duration_column_gives_the_arrival(spark):
    from tarmac.sources.tables import with_actual_arrival

    t = make_tables(spark, flights_v=[flight(1, ad="2016-09-13 23:00:00", aa="2016-09-15 00:30:05"), flight(2)])
    given = t.flights_v.selectExpr("* except (actual_arrival)", "if(flight_id = 1, '25:30:05.7', null) as actual_duration")
    got = {r.flight_id: r.actual_arrival for r in with_actual_arrival(given).collect()}
    assert got == {r.flight_id: r.actual_arrival for r in t.flights_v.collect()}
    assert with_actual_arrival(t.flights_v) is t.flights_v


def test_calc_cli_main(spark, tmp_path):
    from tarmac.jobs import main
    from tarmac.plans.registry import BOUND_PARAMS, bound_mart
    from tarmac.sources.tables import TABLES

    views = from_star_schema(spark, SF001)
    root = tmp_path / "bookings"
    for name in TABLES:
        getattr(views, name).write.parquet(str(root / name))
    args = ["calc", "--parquet-root", str(root), "--table", "cli_results", "--path", str(tmp_path / "out")]
    for question, kwargs in BOUND_PARAMS.items():
        args += [f"--param={question}.{k}={v}" for k, v in kwargs.items()]
    main(args)
    assert sorted(spark.table("cli_results").collect()) == sorted(bound_mart(spark, SF001).collect())


def test_extract_load_job_wiring(spark, tmp_path, monkeypatch):
    """run_extract_load end to end, with the JDBC read replaced by the
    bookings views (no database is available here)."""
    import tarmac.jobs as jobs

    views = from_star_schema(spark, SF001)
    reads = []

    def fake_read(spark_, source, table, split=None):
        reads.append((table, split))
        return getattr(views, table.split(".")[-1])

    monkeypatch.setattr(jobs, "read_table", fake_read)
    out = jobs.run_extract_load(spark, JdbcSource("jdbc:none"), "bookings", None, str(tmp_path),
                                splits={"flights_v": "flight_id"}, partitions=4, modulo=True)
    assert [t for t, _ in reads] == ["bookings.seats", "bookings.flights_v"]
    assert reads[0][1] is None and reads[1][1] == ModuloSplit("flight_id", 4)
    assert sorted(out["seats"].collect()) == sorted(views.seats.collect())
    assert out["flights_v"].count() == views.flights_v.count()
    assert "actual_departure_date" in out["flights_v"].columns
    assert any(d.startswith("actual_departure_date=") for d in os.listdir(tmp_path / "flights_v"))


def test_copy_by_day_replaces_all_days_even_in_dynamic_mode(spark, tmp_path):
    path = str(tmp_path / "fv")
    first = make_tables(spark, flights_v=[flight(1, ad="2016-09-01 10:00:00", aa="2016-09-01 11:00:00"),
                                          flight(2, ad="2016-09-02 10:00:00", aa="2016-09-02 11:00:00")])
    second = make_tables(spark, flights_v=[flight(3, ad="2016-09-02 12:00:00", aa="2016-09-02 13:00:00")])
    copy_by_day(spark, first.flights_v, "actual_departure", "test_fv_dyn", path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        copy = copy_by_day(spark, second.flights_v, "actual_departure", "test_fv_dyn", path)
        assert sorted(r["flight_id"] for r in copy.collect()) == [3]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
