import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidemark.llm import neighbours as N


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, score string"
    )


def by_hand(rows, k, every=5):
    usable = [
        (i, v) for i, v in dict(rows).items()
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = set()
    for q, a in usable:
        if q % every:
            continue
        scored = []
        for c, b in usable:
            if c != q and len(b) == len(a):
                s = 0.0
                for x, y in zip(a, b):
                    s += x * y
                scored.append((-s, c))
        out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k])}
    return out


def rows_of(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equal_to_all_pairs_with_ties_and_odd_rows(spark, monkeypatch, kind):
    monkeypatch.setattr(N, "QUERY_GROUP", 7)
    rng = np.random.default_rng(4)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(150)]
    data += [(150 + i, data[10][1]) for i in range(40)]  # copies: ties go to the smaller id
    data += [
        (200, None), (205, []), (210, [0.0] * 8), (215, [float("nan")] + [1.0] * 7), (220, [float("inf")] + [1.0] * 7),
        (225, [None] + [1.0] * 7), (230, [1.0, 2.0]), (235, [2.0, 1.0]), (None, [1.0] * 8), (240, [1e-42] * 8),
        (245, [1e15] * 8),
    ]
    got = rows_of(N.search(frame(spark, data, kind), F.col("vec_id") % 5 == 0, 6))
    data = [(i, v and [None if x is None else float(np.float32(x)) if kind == "float" else x for x in v]) for i, v in data]
    assert got == by_hand(data, 6)


def test_error_bounds_hold():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(50, 33)) * 10 ** rng.uniform(-3, 3, (50, 1)), rng.normal(size=(70, 33))
    least, most = N.Quantised(a).bounds(N.Quantised(b))
    assert ((least <= a @ b.T) & (a @ b.T <= most)).all()
    assert (most - least < 0.2 * np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))).all()


@pytest.mark.parametrize("one", [-320, -200, 0, 200, 307])
@pytest.mark.parametrize("two", [-320, -200, 0, 200, 307])
def test_bounds_hold_over_the_range_of_doubles(one, two):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(30, 9)) * 10.0**one, rng.normal(size=(40, 9)) * 10.0**two
    a, b = a[np.abs(a).max(axis=1) > 0], b[np.abs(b).max(axis=1) > 0]
    least, most = N.Quantised(a).bounds(N.Quantised(b))
    scores = N.exact(np.repeat(a, len(b), axis=0), np.tile(b, (len(a), 1))).reshape(len(a), len(b))
    assert not np.isnan(least).any() and not np.isnan(most).any()
    assert (~(scores < least) & ~(scores > most)).all()


def test_bounds_prune_most_pairs(monkeypatch):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(20, 64))
    seen = []
    exact = N.exact
    monkeypatch.setattr(N, "exact", lambda x, y: seen.append(len(x)) or exact(x, y))
    one = np.ones(1000, np.int64)
    tile = N.Tile(np.arange(20), one[:20], a, 10)
    for k in range(5):
        tile.add(np.arange(1000) + 1000 * (k + 1), one, rng.normal(size=(1000, 64)))
    assert sum(seen) < 0.05 * 20 * 5000


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_repeated_rows_are_all_found_but_the_asking_one(spark):
    data = [(0, [2.0, 1.0]), (5, [6.0, 1.0]), (5, [99.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    got = results(N.search(frame(spark, data, "double"), F.col("vec_id") % 5 == 0, 4))
    assert [r for r in got if r[0] == 0] == [(0, 1, 5, 199.0), (0, 2, 5, 13.0), (0, 3, 7, 3.0), (0, 4, 7, 3.0)]
    five = [r for r in got if r[0] == 5]  # one of both rows asks, the other is found
    assert len(five) == 4 and five[0][2:] == (5, 595.0)
    # an asking row that stands there twice finds its copy
    copies = results(N.search(frame(spark, data + data, "double"), F.col("vec_id") == 0, 12))
    assert len(copies) == 11 and (0, 5.0) in [r[2:] for r in copies]
    assert [r[2] for r in copies].count(7) == 6


@pytest.mark.parametrize("size", [1e-320, 1e-200, 1e-150, 1e150, 1e200, 1e307])
def test_components_of_any_size(spark, size):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(size=4) * size * 10 ** rng.uniform(-1, 1)]) for i in range(60)]
    data += [(60 + i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    data = [(i, [max(min(x, 1e308), -1e308) for x in v]) for i, v in data]
    got = results(N.search(frame(spark, data, "double"), F.col("vec_id") % 5 == 0, 7))
    usable = [(i, np.array(v)) for i, v in data if any(v)]
    want = []
    for q, a in usable:
        if q % 5:
            continue
        scores = [(c, float(N.exact(a[None], b[None])[0])) for c, b in usable if c != q]
        order = sorted(scores, key=lambda r: (not math.isnan(r[1]), 0 if math.isnan(r[1]) else -r[1], r[0]))
        want += [(q, k + 1, c, s) for k, (c, s) in enumerate(order[:7])]
    assert [(r[:3], str(r[3])) for r in got] == [(r[:3], str(r[3])) for r in want]


def test_one_huge_component_loses_no_row(spark):
    data = [(i, [1e200, i + 1.0, 2.0]) for i in range(200)]
    got = results(N.search(frame(spark, data, "double"), F.col("vec_id") % 20 == 0, 20))
    assert len(got) == 200 and all(r[3] == math.inf for r in got)
    assert [r[2] for r in got if r[0] == 40] == list(range(20))


def test_empty_tables(spark):
    none = frame(spark, [(1, [1.0])])
    assert N.search(none.where("false"), F.col("vec_id") % 5 == 0).collect() == []
    assert N.search(none, F.col("vec_id") % 5 == 0).collect() == []


def test_sql_twin(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    name = "op9_nearest_neighbours"
    assert compare(spark, connect(sf_dir), name, QUERIES[name], N.SQL, sf_dir) is None
