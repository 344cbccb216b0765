"""Imputation against hand-computed values and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean, impute, knn
from tidemark.settings import ImputeRule

SMALL = [
    (25.0, 50000.0, "A"),
    (None, 60000.0, "B"),
    (35.0, None, None),
    (40.0, 80000.0, "A"),
    (None, 55000.0, "C"),
]


@pytest.fixture
def small(spark):
    return spark.createDataFrame(SMALL, "Age double, Income double, Category string")


def test_five_row_frame(small):
    rows = impute.fit_imputer(small).transform(small).collect()
    assert [r["Age"] for r in rows] == [25.0, 35.0, 35.0, 40.0, 35.0]
    assert rows[2]["Income"] == 57500.0 and rows[2]["Category"] == "A"


def test_statistics_survive_a_round_trip(spark, small, tmp_path):
    fitted = impute.fit_imputer(small)
    fitted.to_frame(spark).write.parquet(str(tmp_path / "stats"))
    again = impute.load_imputer(spark.read.parquet(str(tmp_path / "stats")))
    assert again.transform(small).collect() == fitted.transform(small).collect()


def test_default_rule_by_missing_share():
    rule = ImputeRule(numeric="mean", per_feature={"Z": "constant"})
    assert impute.strategy_for("X", True, 9.9, rule) == "mean"
    assert impute.strategy_for("X", True, 10.0, rule) == "median"
    assert impute.strategy_for("X", False, 10.0, rule) == "most_frequent"
    assert impute.strategy_for("Z", True, 50.0, rule) == "constant"


def test_sparse_means_strictly_more_than_half(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, None), (None, 2.0), (3.0, None), (None, 5.0)], "a double, b double")
    filled = impute.fit_imputer(df).transform(df)
    assert filled.columns == ["b"]
    half = df.limit(4)
    assert impute.fit_imputer(half).transform(half).columns == ["a", "b"]
    kept = impute.fit_imputer(df, ImputeRule(keep_sparse=True)).transform(df)
    assert kept.where("a = 0").count() == 3


def test_values_missing_only_at_scoring(spark, small):
    fitted = impute.fit_imputer(small.na.drop())
    row = fitted.transform(
        spark.createDataFrame([(None, None, None)], small.schema)
    ).first()
    assert (row["Age"], row["Income"], row["Category"]) == (32.5, 65000.0, "A")


def test_masks_become_missing_before_the_fit(spark):
    df = spark.createDataFrame([("x",), ("Unknown",), ("x",), ("_______",)], "job string")
    assert [r[0] for r in impute.fit_imputer(df).transform(df).collect()] == ["x"] * 4


def test_text_age_is_repaired_not_windowed(spark):
    text = spark.createDataFrame([("39_",), ("-500",), ("?",)], "Age string")
    assert [r[0] for r in clean.unmask_missing(text).collect()] == [39.0, -500.0, None]
    number = spark.createDataFrame([(39,), (-500,), (17,), (121,)], "Age int")
    assert [r[0] for r in clean.unmask_missing(number).collect()] == [39, None, None, None]


def test_chain_recovers_a_linear_relation(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(10, 2, 400), rng.normal(-3, 5, 400)
    c = 2 * a - 0.5 * b + 7
    rows = [
        (float(x), float(y), None if i % 5 == 0 else float(z))
        for i, (x, y, z) in enumerate(zip(a, b, c))
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    rule = ImputeRule(per_feature={"c": "iterative"})
    filled = impute.fit_imputer(df, rule).transform(df).toPandas()
    assert np.allclose(filled["c"], c, atol=1e-4)


def test_chain_matches_a_row_by_row_rerun(spark):
    """Several gappy columns: the pattern algebra equals chained regressions on the rows."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 1)) + 0.5 * rng.normal(size=(300, 3))
    gaps = rng.random(x.shape) < np.array([0.1, 0.2, 0.3])
    rows = [tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gaps)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    rule = ImputeRule(per_feature={k: "iterative" for k in "abc"}, max_iter=4, tol=0.0)
    got = impute.fit_imputer(df, rule).transform(df).toPandas().to_numpy()

    seen = np.where(gaps, np.nan, x)
    mean, std = np.nanmean(seen, axis=0), np.nanstd(seen, axis=0, ddof=1)
    z = np.where(gaps, 0.0, (seen - mean) / std)
    for _ in range(4):
        for j in np.argsort(gaps.sum(axis=0), kind="stable"):
            others = [i for i in range(3) if i != j]
            design = np.column_stack([np.ones(300), z[:, others]])
            known = ~gaps[:, j]
            w = np.linalg.lstsq(design[known], z[known, j], rcond=None)[0]
            z[gaps[:, j], j] = design[gaps[:, j]] @ w
    assert np.allclose(got, z * std + mean, atol=1e-5)


def _brute(receivers, donors, target, k, total):
    """All pairs in plain Python; copies of a donor stand at their mean target."""
    copies = {}
    for d, y in zip(donors, target):
        copies.setdefault(d, []).append(y)
    out = []
    for r in receivers:
        found = []
        for d, ys in copies.items():
            shared = [(a - b) ** 2 for a, b in zip(r, d) if a is not None and b is not None]
            if shared:
                distance = (sum(shared) * total / len(shared)) ** 0.5
                found += [(distance, sum(ys) / len(ys))] * len(ys)
        near = sorted(found)[:k]
        out.append(sum(y for _, y in near) / len(near) if near else None)
    return out


@pytest.mark.parametrize("gaps_share", [0.15, 0.3])
@pytest.mark.parametrize("block_rows", [20_000, 37])
def test_neighbours_equal_brute_force(spark, monkeypatch, block_rows, gaps_share):
    """Small blocks force several ranges, sub-blocks on both sides and a hot coordinate."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(knn, "SAMPLE", 40)
    rng = np.random.default_rng(2)

    def points(n):
        x = np.round(rng.normal(0, 100, (n, 3)), 1)
        x[: n // 3, 0] = 5.0
        gaps = rng.random((n, 3)) < gaps_share
        return [tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gaps)]

    donors, receivers = points(300), points(90)
    target = [float(y) for y in rng.permutation(300)]
    schema = "a double, b double, c double"
    got = knn.neighbour_means(
        spark.createDataFrame(receivers, schema),
        spark.createDataFrame([(*d, y) for d, y in zip(donors, target)], schema + ", y double"),
        ["a", "b", "c"], "y", k=5, total=4,
    )
    by_place = {(r["a"], r["b"], r["c"]): r["neighbour_mean"] for r in got.collect()}
    want = _brute(receivers, donors, target, 5, 4)
    assert len(by_place) == len({r for r, mean in zip(receivers, want) if mean is not None})
    for place, mean in zip(receivers, want):
        assert by_place.get(place) == pytest.approx(mean)


def test_gaps_do_not_bring_all_pairs_together():
    """Pairs compared stay a small part of all pairs, with a third of every coordinate missing."""
    rng = np.random.default_rng(7)
    n, cells = 4000, 40
    x = rng.normal(0, 100, (n, 3))
    x[rng.random((n, 3)) < 0.3] = np.nan
    receivers, donors = x[:400], x[400:]
    sample = donors[:200]
    reach = knn._reach(receivers, sample, np.ones(200, np.int64), 5, 3)
    edges = [np.array(knn._edges(sample[:, i], cells)) for i in range(3)]
    coarse = [np.array(knn._edges(sample[:, i], knn.SECOND_CELLS)) for i in range(3)]
    pairs = 0
    for i, j in ((0, 1), (1, 0), (2, 0)):
        home = np.searchsorted(edges[i], donors[:, i], "right")
        other = np.where(np.isnan(donors[:, j]), -1, np.searchsorted(coarse[j], donors[:, j], "right"))
        for r, bound in zip(receivers, reach):
            if np.isnan(r[i]):
                continue
            at = (home >= np.searchsorted(edges[i], r[i] - bound, "right")) & (
                home <= np.searchsorted(edges[i], r[i] + bound, "right")
            )
            if not np.isnan(r[j]):
                at &= (other < 0) | (
                    (other >= np.searchsorted(coarse[j], r[j] - bound, "right"))
                    & (other <= np.searchsorted(coarse[j], r[j] + bound, "right"))
                )
            pairs += int((at & ~np.isnan(donors[:, i])).sum())
    assert pairs < 0.25 * len(receivers) * len(donors)


def test_copies_count_as_often_as_they_occur(spark):
    donors = spark.createDataFrame([(0.0, 10.0)] * 4 + [(1.0, 20.0), (2.0, 90.0)], "a double, y double")
    receivers = spark.createDataFrame([(0.0,)], "a double")
    got = knn.neighbour_means(receivers, donors, ["a"], "y", k=5).first()
    assert got["neighbour_mean"] == pytest.approx((4 * 10 + 20) / 5)


def test_batch_fallback(spark, small):
    rows = impute.fill_from_batch(small).collect()
    assert rows[1]["Age"] == 35.0 and rows[2]["Category"] == "A"


def test_transform_adds_no_shuffle(spark, small):
    fitted = impute.fit_imputer(small, ImputeRule(per_feature={"Income": "iterative"}))
    plan = fitted.transform(small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_null_rows_do_not_meet_in_one_join_key(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 6.0)], "a double, b double")
    filled = knn.fill_from_neighbours(df, df, ["a", "b"], ["b"], k=1)
    assert sorted((r["a"], r["b"]) for r in filled.collect())[1] == (2.0, 2.0)
    assert filled.where(F.col("b").isNull()).isEmpty()


def test_chain_with_more_patterns_than_any_batch(spark):
    """2**10 patterns of missing columns, spread over partitions, against plain normal equations."""
    from tidemark.operators.impute import fit_chain

    rng = np.random.default_rng(0)
    d, n = 11, 3000
    x = rng.normal(size=(n, 1)) + 0.3 * rng.normal(size=(n, d))
    hole = rng.random((n, d)) < 0.4
    hole[:, 0] = False
    rows = [[None if h else float(v) for v, h in zip(r, m)] for r, m in zip(x, hole)]
    names = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    zero, one = {c: 0.0 for c in names}, {c: 1.0 for c in names}
    chain = fit_chain(df, names, zero, one, max_iter=2, tol=0.0)
    assert len({tuple(m) for m in hole}) > 800
    filled, steps = np.where(hole, 0.0, x), iter(chain.steps)
    for _ in range(2):
        for _ in range(d - 1):
            j, b, w = next(steps)
            seen = ~hole[:, j]
            others = [k for k in range(d) if k != j]
            a = np.column_stack([np.ones(seen.sum()), filled[seen][:, others]])
            want = np.linalg.lstsq(a, x[seen, j], rcond=None)[0]
            assert np.allclose([b, *np.array(w)[others]], want, atol=1e-6)
            filled[~seen, j] = b + filled[~seen] @ np.array(w)
    assert next(steps, None) is None


def test_saved_imputer_fills_alike(spark, small, tmp_path):
    from tidemark.operators.impute import fit_imputer, read_imputer, save_imputer

    fitted = fit_imputer(small, ImputeRule(keep_sparse=True, drop_above=0.9))
    save_imputer(fitted, spark, str(tmp_path / "i"))
    again = read_imputer(spark, str(tmp_path / "i"))
    assert again.rule == fitted.rule
    assert again.transform(small).exceptAll(fitted.transform(small)).isEmpty()
