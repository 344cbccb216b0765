"""Snapshot states: merged they equal a scan of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, profile, states
from tidemark.plans import profiles
from tidemark.sources import commits


@pytest.fixture(scope="module")
def rows(spark):
    state, out = random.Random(2), []
    for m in (1, 2, 3, 5):
        for _ in range(300 * m):
            x = state.choice([None, float("nan"), state.gauss(m, 3), state.gauss(m, 3), state.gauss(m, 3)])
            out.append((f"2024-0{m}-01", x, state.randrange(50), None))
    df = spark.createDataFrame(out, "d string, x double, k int, nothing double")
    return df.select(F.col("d").cast("date").alias("snapshot_date"), "x", "k", "nothing").persist()


COLUMNS = ["x", "k", "nothing"]


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states") / "t")
    profiles.update(rows.where("snapshot_date = '2024-01-01'"), path, COLUMNS)
    profiles.update(rows.where("snapshot_date > '2024-01-01'"), path, COLUMNS)
    return path


def test_merged_states_equal_a_scan(spark, rows, stored):
    got = {r.feature: r for r in profiles.profile(spark, stored).collect()}
    for c in COLUMNS:
        value = profile.known(rows, c)
        n, mean, std, low, high, u, ranks = rows.agg(
            F.count(value), F.avg(value), F.stddev_samp(value), F.min(value), F.max(value), F.count_distinct(value),
            F.percentile(value, F.array(F.lit(0.48), F.lit(0.52))),
        ).first()
        r = got[c]
        assert (r.rows, r.missing_count, r.low, r.high) == (rows.count(), rows.count() - n, low, high)
        assert r.mean == pytest.approx(mean, abs=1e-9) and r.std == pytest.approx(std, abs=1e-9)
        assert abs(r.distinct_estimate - u) <= 0.06 * u
        assert r.median_estimate is None if not n else ranks[0] <= r.median_estimate <= ranks[1]


def test_stability_of_each_month_equals_the_scan(spark, rows, stored):
    first = F.col("snapshot_date") == "2024-01-01"
    for overflow in ("drop", "bucket"):
        found = profiles.psi(spark, stored, first, overflow).collect()
        got = {(str(r.snapshot_date), r.feature): r.psi for r in found}
        for m in ("2024-02-01", "2024-05-01"):
            now = rows.where(F.col("snapshot_date") == m)
            for r in drift.psi(rows.where(first), now, ["x", "k"], overflow=overflow).collect():
                assert got[m, r.feature] == pytest.approx(r.psi, abs=1e-9)
        assert got["2024-01-01", "x"] == pytest.approx(0, abs=1e-9) and got["2024-02-01", "nothing"] == float("inf")


def test_a_month_again_replaces_its_state_and_reads_no_other(spark, rows, stored):
    before = commits.newest(spark, stored)
    march = rows.where("snapshot_date = '2024-03-01'")
    profiles.update(march.union(march), stored, COLUMNS, ["2024-02-01"])
    after = {(str(r.snapshot_date), r.feature): r.rows for r in profiles.stored(spark, stored).collect()}
    assert after["2024-03-01", "x"] == 1800 and ("2024-02-01", "x") not in after and after["2024-05-01", "k"] == 1500
    kept = {p.version for p in commits.newest(spark, stored).parts} & {p.version for p in before.parts}
    assert kept and commits.newest(spark, stored).notes == before.notes


def test_rolling_windows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    profiles.update(rows, path, ["k"])
    got = {str(r.until): r.rows for r in profiles.rolling(spark, path, 2).collect()}
    assert got == {"2024-01-01": 300, "2024-02-01": 900, "2024-03-01": 1500, "2024-05-01": 1500}


def test_only_states_are_shuffled(rows):
    edges = drift.reference_edges(rows, ["x", "k"], 10)
    text = states.snapshot_states(rows, ["x", "k"], edges)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_hll_sketch_agg" in text


def test_a_bin_is_found_once_a_row(rows):
    """Counting thirteen bins does not find a row's bin thirteen times."""
    edges = {"x": [float(e) for e in range(1000, 1011)]}
    plan = states.snapshot_states(rows, ["x"], edges)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("1005.0") == 1
