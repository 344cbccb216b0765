"""Snapshot tables: changes in one step, rows added once, what a dead job leaves."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sources import commits, readers, writers


@pytest.fixture
def rows(spark):
    def make(*pairs):
        df = spark.createDataFrame(list(pairs), "k int, snapshot_date string")
        return df.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))

    return make


def keys_of(spark, path, snapshot=None):
    return sorted(r.k for r in readers.read_table(spark, path, snapshot).collect())


JAN, FEB, MAR = "2024-01-01", "2024-02-01", "2024-03-01"


def test_a_job_that_dies_before_it_publishes_changes_nothing(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    writers.write_snapshots(rows((1, JAN), (2, FEB)), path)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(commits, "publish", dies)
        writers.write_snapshots(rows((7, JAN), (8, FEB)), path)
    assert keys_of(spark, path) == [1, 2] and keys_of(spark, path, FEB) == [2]
    writers.write_snapshots(rows((9, FEB)), path)
    assert keys_of(spark, path) == [1, 9]


def test_all_months_of_a_write_change_together(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    writers.write_snapshots(rows((1, JAN), (2, FEB), (3, MAR)), path)
    before = commits.newest(spark, path)
    old = commits.read(spark, path, before)
    commits.replace_months(rows((4, JAN), (5, FEB)), path, [MAR], keep=1)
    assert sorted(r.k for r in old.collect()) == [1, 2, 3]  # a reader in flight, its files are kept
    assert keys_of(spark, path) == [4, 5] and commits.newest(spark, path).number == before.number + 1
    writers.write_snapshots(rows((6, JAN)), path)
    assert keys_of(spark, path) == [5, 6]
    assert len(list((tmp_path / "t").rglob("part-*"))) == 2


def test_two_writers_at_once_lose_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    errors = []

    def write(k):
        try:
            writers.write_snapshots(rows((k, f"2024-{k:02d}-01")), path)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 7)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and keys_of(spark, path) == [1, 2, 3, 4, 5, 6]
    assert commits.newest(spark, path).number == 6


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    log = commits.Folder(spark, str(tmp_path / "log"))
    assert log.publish("1.json", "first") and not log.publish("1.json", "second")
    assert log.read("1.json") == "first" and log.names() == ["1.json"]


def test_keys_land_once_also_without_rows(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert commits.add_once(rows((1, JAN)), path, "a")
    assert not commits.add_once(rows((1, JAN)), path, "a")
    assert commits.add_once(rows((1, JAN)).where("false"), path, "b")
    assert not commits.add_once(rows((1, JAN)), path, "b")
    assert commits.add_once(rows((1, JAN), (2, FEB)), path, "c")
    assert keys_of(spark, path) == [1, 1, 2]


def test_a_slower_attempt_of_the_same_batch_leaves_no_files(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    commits.add_once(rows((0, JAN)), path, "z")
    blind = commits.newest(spark, path)
    commits.add_once(rows((1, JAN)), path, "a")
    real, calls = commits.newest, []

    def newest(*args):  # the second attempt looked before the first had published
        calls.append(1)
        return blind if len(calls) == 1 else real(*args)

    monkeypatch.setattr(commits, "newest", newest)
    assert not commits.add_once(rows((1, JAN)), path, "a")
    monkeypatch.undo()
    assert keys_of(spark, path) == [0, 1]
    assert len(list((tmp_path / "t").glob("_data/version=*"))) == 2


def test_compacting_keeps_rows_and_keys(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for k in range(5):
        commits.add_once(rows((k, JAN), (k, FEB)) if k % 2 else rows((k, JAN)), path, f"b{k}")
    assert commits.compact(spark, path, least=4) == [JAN]
    assert keys_of(spark, path, JAN) == [0, 1, 2, 3, 4] and keys_of(spark, path, FEB) == [1, 3]
    assert not commits.add_once(rows((3, JAN)), path, "b3")
    assert len(list((tmp_path / "t").glob(f"_data/*/snapshot_date={JAN}"))) == 1
    assert commits.compact(spark, path, least=4) == []


def test_columns_may_come_and_months_may_have_no_date(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    writers.write_snapshots(rows((1, JAN), (2, None)), path)
    writers.write_snapshots(rows((3, FEB)).withColumn("new", F.lit("x")), path)
    got = {r.k: r.new for r in readers.read_table(spark, path).collect()}
    assert got == {1: None, 2: None, 3: "x"}
    writers.write_snapshots(rows((4, None)), path)
    assert keys_of(spark, path) == [1, 3, 4]


def test_plain_parquet_folders_are_still_read(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    rows((1, JAN), (2, FEB)).write.partitionBy("snapshot_date").parquet(path)
    assert keys_of(spark, path, FEB) == [2] and keys_of(spark, path) == [1, 2]


def test_fingerprints(spark):
    rows = [(1, None), (None, 1), (2, 2), (2, 2)]
    def f(r, **k):
        return commits.fingerprint(spark.createDataFrame(r, "a int, b int"), **k)

    assert f(rows) == f(rows[::-1])
    assert len({f(rows), f(rows[:3]), f([(None, 1), (None, 1), *rows[2:]]), f([]), f([(None, None)])}) == 5
    assert f(rows, without=["b"]) == f([(a, 7) for a, _ in rows], without=["b"])


def test_a_repeated_monitoring_run_replaces_its_document(spark, tmp_path):
    out = str(tmp_path / "m")
    for status in ("OK", "ALERT"):
        writers.write_monitoring_summary(spark.createDataFrame([(status,)], "status string"), out, run="2024-05")
    writers.write_monitoring_summary(spark.createDataFrame([("OK",)], "status string"), out)
    assert sorted(r.status for r in spark.read.json(out, schema="status string", recursiveFileLookup=True).collect()) == ["ALERT", "OK"]
