"""Stored codes: over runs, reruns, late values and writers at once."""

from pyspark.sql import functions as F

from tidemark.operators import lookups
from tidemark.plans import dictionary
from tidemark.sources import commits


def frame(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "v string, snapshot_date string")
    return df.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def codes(df):
    return {r.v: r.code for r in df.collect()}


def test_new_values_join_the_end_and_old_codes_stay(spark, tmp_path):
    path = str(tmp_path / "d")
    add = lambda *pairs: codes(dictionary.with_values_of(frame(spark, *pairs), path, "v", "code"))
    first = add(("m", "2024-02-01"), ("x", "2024-01-01"), ("m", "2024-01-01"), (None, "2024-01-01"))
    assert first == {"m": 0, "x": 1}
    assert add(("x", "2024-01-01")) == first  # one month again
    assert add(("z", "2024-03-01"), ("a", "2024-03-01"), ("m", "2024-03-01")) == {**first, "a": 2, "z": 3}
    whole = dictionary.stored(spark, path, "v", "code")
    assert {r.v: str(r.snapshot_date) for r in whole.collect()} == {
        "m": "2024-01-01", "x": "2024-01-01", "a": "2024-03-01", "z": "2024-03-01"
    }
    assert commits.newest(spark, path).number == 2


def test_without_values(spark, tmp_path):
    path = str(tmp_path / "d")
    got = dictionary.with_values_of(frame(spark, (None, "2024-01-01")), path, "v", "code")
    assert got.count() == 0 and dictionary.stored(spark, path, "v", "code") is None
    coded = lookups.with_codes(frame(spark, (None, "2024-01-01")), "v", "code", -1, got)
    assert coded.first().code == -1


def test_a_run_that_was_overtaken_looks_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    real, calls = commits.add_after, []

    def overtaken(df, where, seen):
        if not calls:
            calls.append(1)
            real(dictionary_rows(spark), where, seen)
        return real(df, where, seen)

    monkeypatch.setattr(commits, "add_after", overtaken)
    got = codes(dictionary.with_values_of(frame(spark, ("b", "2024-01-01"), ("c", "2024-01-01")), path, "v", "code"))
    assert got == {"b": 0, "c": 1, "a": 2} or got == {"a": 0, "b": 1, "c": 2}
    assert len(set(got.values())) == 3


def dictionary_rows(spark):
    return frame(spark, ("a", "2024-01-01")).withColumn("code", F.lit(0)).select("v", "code", "snapshot_date")


def test_many_values_have_each_their_own_code(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.range(3000).select(F.col("id").cast("string").alias("v"), F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    dictionary.with_values_of(df.where("id % 3 = 0"), path, "v", "code")
    got = codes(dictionary.with_values_of(df, path, "v", "code"))
    assert sorted(got.values()) == list(range(3000))
    old = sorted(str(k) for k in range(0, 3000, 3))
    assert [got[v] for v in old] == list(range(1000))


def test_labels_without_a_key_do_not_meet_in_one_task(spark):
    labels = spark.range(4000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("label"))
    features = spark.createDataFrame([("a", 1), (None, 2)], "k string, f int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        joined = lookups.labelled(labels, features, "left", ["k"])
        sizes = [len(p) for p in joined.rdd.glom().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 1200
        assert joined.where("f is not null").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
