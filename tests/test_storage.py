"""Written tables, scratch folders and re-reading of inputs."""

from __future__ import annotations

import os
import shutil
from urllib.parse import urlparse

import pytest

from tarmac import session
from tarmac.plans import registry
from tests.conftest import SF001, SF01


def test_files_added_between_two_calls_are_seen(spark, tmp_path):
    for t in ("orders", "customer", "lineitem", "part", "supplier", "nation"):
        os.makedirs(tmp_path / f"{t}.parquet")
        shutil.copy(f"{SF001}/{t}.parquet", tmp_path / f"{t}.parquet" / "a.parquet")
    run = registry.queries()["q10_cities_multi_airport"]
    before = run(spark, str(tmp_path)).count()
    shutil.copy(f"{SF01}/supplier.parquet", tmp_path / "supplier.parquet" / "b.parquet")
    assert run(spark, str(tmp_path)).count() > before


@pytest.mark.parametrize("key", ["el_copy_seats", "el_copy_flights_by_day", "append_answers", "mart_results"])
def test_a_second_call_leaves_the_first_result_alone(spark, key):
    run = registry.queries()[key]
    first = run(spark, SF001)
    want = sorted(map(str, first.collect()))
    run(spark, SF01).count()
    assert sorted(map(str, first.collect())) == want


def _folders(spark) -> set[str]:
    top = urlparse(session.scratch_root(spark)).path
    return {d for d in os.listdir(top) if d.startswith("tarmac_stage")} if os.path.isdir(top) else set()


def test_the_mart_removes_its_stage(spark):
    before = _folders(spark)
    registry.mart_results(spark, SF001).count()
    assert _folders(spark) == before


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({k.replace("__", "."): v for k, v in conf.items()})


def test_local_folders_are_refused_on_a_cluster():
    remote = _Session(spark__master="yarn", spark__sql__warehouse__dir="file:/home/x/spark-warehouse")
    with pytest.raises(ValueError, match="folder of one machine"):
        session.storage_root(remote)
    with pytest.raises(ValueError, match="folder of one machine"):
        session.scratch_root(remote)
    remote.conf["spark.checkpoint.dir"] = "hdfs://nn/scratch"
    assert session.scratch_root(remote) == "hdfs://nn/scratch"
    shared = _Session(spark__master="yarn", spark__sql__warehouse__dir="hdfs://nn/warehouse/", spark__checkpoint__dir="hdfs://nn/scratch")
    assert session.storage_root(shared) == "hdfs://nn/warehouse"


@pytest.fixture
def on_a_cluster(spark):
    """The session with the master's name of a cluster; its tasks run here."""
    master = spark.conf.get("spark.master")
    spark.conf.set("spark.master", "spark://host:7077")
    yield spark
    spark.conf.set("spark.master", master)


WRITING = ["append_answers", "bucketed_airtime", "el_copy_flights_by_day", "el_copy_seats", "el_sync_flights_by_day",
           "interval_long_flights", "mart_results"]


@pytest.mark.parametrize("key", WRITING)
def test_a_local_folder_that_all_tasks_see_is_written(on_a_cluster, key):
    for folder in (session.storage_root(on_a_cluster), session.scratch_root(on_a_cluster)):
        assert not [f for f in os.listdir(urlparse(folder).path) if f.startswith(("_seen_", "._seen_"))]
    assert registry.queries()[key](on_a_cluster, SF001).count() > 0


def test_a_local_folder_that_tasks_do_not_see_is_refused(on_a_cluster, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_seen_by_tasks", lambda spark, folder: False)
    with pytest.raises(ValueError, match="folder of one machine"):
        session.storage_root(on_a_cluster)
    monkeypatch.undo()
    assert session._seen_by_tasks(on_a_cluster, f"file:{tmp_path}/a b")


def test_tables_are_never_under_the_checkpoint_folder(spark):
    assert not session.storage_root(spark).startswith(session.scratch_root(spark))
