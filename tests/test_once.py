"""Streams that repeat rows, restart or fail midway; joins of tables stored by key."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import bucketed, commits, readers
from tidemark.streaming import once


@pytest.fixture
def arrivals(spark, tmp_path):
    def send(*rows, delay="1 day"):
        df = spark.createDataFrame([(k, t) for k, t in rows], "k string, t string")
        df = df.withColumn("t", F.col("t").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        places = [str(tmp_path / p) for p in ("landed", "late")]
        once.land_once(stream, *places, ["k"], "t", delay, str(tmp_path / "cp")).awaitTermination()
        found = []
        for p in places:
            rows = readers.read_table(spark, p).collect() if commits.newest(spark, p) else []
            found.append(sorted(f"{r.k}@{r.t:%m-%d}" for r in rows))
        return found

    return send


def test_rows_land_once_across_batches(arrivals):
    assert arrivals(("a", "2024-01-05"), ("a", "2024-01-05"), ("b", "2024-01-31"), (None, "2024-01-31"), (None, "2024-01-31")) == [
        ["None@01-31", "None@01-31", "a@01-05", "b@01-31"], []
    ]
    # b again, c new, d behind the watermark of the batch before, e without a time
    landed, late = arrivals(("b", "2024-01-31"), ("c", "2024-02-03"), ("d", "2024-01-29"))
    assert landed == ["None@01-31", "None@01-31", "a@01-05", "b@01-31", "c@02-03"] and late == ["d@01-29"]
    landed, late = arrivals(("b", "2024-01-31"), ("c", "2024-02-02"))
    assert landed[-1] == "c@02-03" and len(landed) == 5 and late == ["b@01-31", "d@01-29"]


def test_a_batch_that_failed_between_both_tables_is_finished(spark, tmp_path, arrivals, monkeypatch):
    arrivals(("a", "2024-01-05"), ("b", "2024-01-31"))
    real, calls = commits.add_once, []

    def dies(df, path, key, *args, **kwargs):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(df, path, key, *args, **kwargs)

    with monkeypatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(commits, "add_once", dies)
        arrivals(("c", "2024-02-01"), ("d", "2024-01-01"))
    landed, late = arrivals(("c", "2024-02-01"), ("e", "2024-02-02"))
    assert landed == ["a@01-05", "b@01-31", "c@02-01", "e@02-02"] and late == ["d@01-01"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_stored_tables_shuffle_nothing(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        day = F.lit("2024-01-01").cast("date").alias("snapshot_date")
        left = spark.range(500).select(F.col("id").cast("string").alias("Customer_ID"), day, F.col("id").alias("x"))
        right = spark.range(300, 800).select(F.col("id").cast("string").alias("Customer_ID"), day, (F.col("id") * 2).alias("y"))
        tables = ["stored_left", "stored_right"]
        for name, df, n in zip(tables, (left, right), (8, 4)):
            bucketed.store(df, name, str(tmp_path / name), buckets=n)
        joined = bucketed.join(spark, tables)
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        want = left.join(right, ["Customer_ID", "snapshot_date"], "left")
        assert "Exchange" in plan(want)
        assert sorted(joined.collect()) == sorted(want.collect())
        grouped = bucketed.aggregate(spark, tables[0], [F.sum("x").alias("x")])
        assert "Exchange" not in plan(grouped) and grouped.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("stored_left", "stored_right"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucket_counts():
    assert [bucketed.buckets_for(n, 10) for n in (0, 1, 10, 11, 35, 41)] == [1, 1, 1, 2, 4, 8]
