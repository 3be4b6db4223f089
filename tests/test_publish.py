"""Publication of whole versions, and copies brought up to date by day."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from tarmac.plans import extract_load, publish
from tarmac.plans.mart import RESULTS_SCHEMA, append_answer, write_results
from tarmac.plans.publish import published, published_folder, versions
from tarmac.plans.questions import q10_cities_multi_airport
from tests.conftest import flight, make_tables


def answers(spark, *rows):
    return spark.createDataFrame(list(rows), RESULTS_SCHEMA)


def broken_after_some_files(spark, folder):
    """Rows whose last partition fails once files of the others are there."""
    def fail(batches):
        import glob
        import time

        for batch in batches:
            if batch.num_rows and batch.column(0)[0].as_py() == 99:
                until = time.time() + 20
                while time.time() < until and not glob.glob(f"{folder}/0*/**/part-*", recursive=True):
                    time.sleep(0.05)
                raise RuntimeError("killed between files")
            yield batch

    rows = spark.createDataFrame([(i, "new") for i in (1, 2, 3, 99)], RESULTS_SCHEMA).repartitionByRange(4, "id")
    return rows.mapInArrow(fail, RESULTS_SCHEMA)


def test_a_write_that_dies_between_files_leaves_the_old_answers(spark, tmp_path):
    root = str(tmp_path / "results")
    write_results(answers(spark, (1, "old"), (2, None)), "publish_killed", root)
    held = spark.table("publish_killed")
    with pytest.raises(Exception, match="killed between files"):
        write_results(broken_after_some_files(spark, root), "publish_killed", root)
    for read in (held, spark.table("publish_killed"), published(spark, root)):
        assert sorted(map(tuple, read.collect()), key=str) == [(1, "old"), (2, None)]
    write_results(answers(spark, (1, "new")), "publish_killed", root)
    assert [tuple(r) for r in spark.table("publish_killed").collect()] == [(1, "new")]
    assert sorted(map(tuple, held.collect()), key=str) == [(1, "old"), (2, None)]  # the version before stays


def test_a_run_that_dies_before_publication_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "results")
    publish.publish(answers(spark, (1, "old")), root, "publish_unmarked")

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(publish, "_mark", die)
        with pytest.raises(KeyboardInterrupt):
            publish.publish(answers(spark, (1, "new")), root, "publish_unmarked")
        # killed so hard that nothing was cleared away
        m.setattr(publish, "remove_folder", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            publish.publish(answers(spark, (1, "new")), root, "publish_unmarked")
    assert published(spark, root).first().response == spark.table("publish_unmarked").first().response == "old"
    publish.publish(answers(spark, (1, "newer")), root, "publish_unmarked")
    assert published(spark, root).first().response == spark.table("publish_unmarked").first().response == "newer"


def test_readers_during_replacements_see_whole_versions(spark, tmp_path):
    root = str(tmp_path / "v")
    make = lambda k: spark.range(40).select(F.lit(k).cast("int").alias("id"), F.col("id").cast("string").alias("response")).repartition(4)
    publish.publish(make(0), root, keep=4)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append([tuple(r) for r in published(spark, root).groupBy("id").count().collect()])

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 4):
        publish.publish(make(k), root, keep=4)
    stop.set()
    reader.join()
    assert seen and all(len(s) == 1 and s[0][1] == 40 for s in seen)


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "v")
    assert published(spark, root) is None and published_folder(spark, root) is None
    for k in range(12):
        publish.publish(answers(spark, (k, "x")), root)
    assert len(versions(spark, root)) == 2 and published(spark, root).first().id == 11
    assert len([d for d in os.listdir(root) if d[0] != "_"]) == 2
    with pytest.raises(ValueError):
        publish.publish(answers(spark), root, keep=0)


def test_append_goes_to_the_current_version(spark, tmp_path):
    t = make_tables(spark, airports=[(1, "A"), (2, "A")])
    root = str(tmp_path / "r")
    write_results(answers(spark, (1, "one")), "publish_append", root)
    out = append_answer(spark, q10_cities_multi_airport, t, "publish_append", root)
    assert sorted(map(tuple, out.collect())) == [(1, "one"), (10, "A")]
    write_results(answers(spark, (5, "five")), "publish_append", root)
    assert [tuple(r) for r in spark.table("publish_append").collect()] == [(5, "five")]


def _files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.startswith("part-")) for d in os.listdir(path) if "=" in d}


def _rows(df, timestamp="actual_departure"):
    return sorted(map(str, df.withColumn("actual_departure_date", F.to_date(timestamp)).collect()))


DAYS = [flight(i, ad=f"2016-09-{i % 5 + 1:02d} 0{i % 7}:00:00", aa="2016-09-09 00:00:00") for i in range(1, 30)] + [flight(90, status="Scheduled")]


def test_second_run_rewrites_the_changed_day_only(spark, tmp_path):
    path = str(tmp_path / "fv")
    first = make_tables(spark, flights_v=DAYS).flights_v
    assert sorted(map(str, extract_load.sync_by_day(spark, first, "actual_departure", path).collect())) == _rows(first)
    before = _files(path)
    assert len(before) == 6
    assert sorted(map(str, extract_load.sync_by_day(spark, first, "actual_departure", path).collect())) == _rows(first)
    assert _files(path) == before  # nothing changed
    changed = first.withColumn("status", F.when(F.col("flight_id") == 7, "Departed").otherwise(F.col("status")))  # 2016-09-03
    assert sorted(map(str, extract_load.sync_by_day(spark, changed, "actual_departure", path).collect())) == _rows(changed)
    after = _files(path)
    assert {d for d in before if before[d] != after[d]} == {"actual_departure_date=2016-09-03"}


def test_days_that_come_and_go_and_unknown_days(spark, tmp_path):
    path = str(tmp_path / "fv")
    make = lambda rows: make_tables(spark, flights_v=rows).flights_v
    extract_load.sync_by_day(spark, make(DAYS), "actual_departure", path)
    for rows in ([r for r in DAYS if r[7] is not None and r[7].day != 2], DAYS + [flight(200, ad="2017-01-01 00:00:00")], [], DAYS + DAYS):
        now = make(rows)
        got = extract_load.sync_by_day(spark, now, "actual_departure", path)
        assert sorted(map(str, got.collect())) == _rows(now)


def test_a_run_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fv")
    first = make_tables(spark, flights_v=DAYS).flights_v
    extract_load.sync_by_day(spark, first, "actual_departure", path)
    other = first.withColumn("status", F.when(F.col("flight_id") == 7, "Departed").otherwise(F.col("status")))
    real, calls = extract_load.publish, []

    def die_at_the_end(*args):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(*args)

    monkeypatch.setattr(extract_load, "publish", die_at_the_end)
    with pytest.raises(KeyboardInterrupt):
        extract_load.sync_by_day(spark, other, "actual_departure", path)
    monkeypatch.undo()
    # the day was rewritten without a fingerprint, so the old rows come back too
    assert sorted(map(str, extract_load.sync_by_day(spark, first, "actual_departure", path).collect())) == _rows(first)


def test_fingerprints_tell_nulls_and_copies_apart(spark):
    rows = [("a", None, 1, None), ("b", None, None, 1), ("c", None, 1, 1), ("d", None, 2, 2)]
    df = spark.createDataFrame(rows, "d string, t int, x int, y int")
    prints = {r.d: (r.n, r.mixed, r.total) for r in extract_load.day_fingerprints(df, "d").collect()}
    assert len(set(prints.values())) == 4
    copies = extract_load.day_fingerprints(df.union(df).union(df), "d").collect()
    assert {(r.n, r.mixed, r.total) for r in copies}.isdisjoint(prints.values())
