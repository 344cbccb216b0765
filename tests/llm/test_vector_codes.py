"""Codes against plain Python integers, exactness of slices, odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import vector_codes as V


def brute(rows):
    """The contract in plain Python: rows of (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max((len(r[1]) for r in kept), default=0) // 4)

    def whole(x):
        return max(-(1 << 62), min(1 << 62, math.floor(1024 * x)))

    vectors = [[whole(x) for x in v] + [0] * (4 * size - len(v)) for _, v, _ in kept]
    parts = [[v[p * size : (p + 1) * size] for p in range(4)] for v in vectors]
    books = [[parts[i][p] for i in range(min(256, len(parts)))] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            groups = {}
            for v in parts:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    listed = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(listed.encode()).hexdigest()
    out, errors = [], {}
    for (vec_id, _, label), v in zip(kept, parts):
        found = [nearest(v[p], books[p]) for p in range(4)]
        error = min(sum(d for d, _ in found), (1 << 63) - 1)
        errors[label] = errors.get(label, 0) + error
        out.append((vec_id, "".join(f"{k:02x}" for _, k in found), error, label))
    return sorted(((i, c, e, min(errors[m], (1 << 63) - 1), digest) for i, c, e, m in out), key=str)


@pytest.fixture
def compressed(spark):
    def run(rows):
        df = spark.createDataFrame(
            [(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int"
        ).repartition(3)
        got = V.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
        return sorted(map(tuple, got), key=str)

    return run


def rows_of(n, seed, width=8, spread=1.0):
    state = random.Random(seed)
    return [(i, [state.gauss(0, spread) for _ in range(width)], state.choice([None, 1, 2])) for i in range(n)]


def test_same_as_plain_python(compressed):
    rows = rows_of(420, 3)
    assert compressed(rows) == brute(rows)


def test_ties_copies_and_one_heavy_label(compressed):
    state = random.Random(5)
    rows = [(i, [state.randrange(2) / 1024 for _ in range(8)], 1 if i % 3 else None) for i in range(600)]
    assert compressed(rows) == brute(rows)


def test_odd_rows(compressed):
    nan, inf = float("nan"), float("inf")
    rows = rows_of(12, 9) + [
        (50, None, 1), (51, [1.0, nan] * 4, 1), (52, [inf] * 8, 1), (53, [-inf] + [0.0] * 7, 1), (54, [None] + [0.0] * 7, 2),
        (None, [0.5] * 8, None), (60, [0.25] * 8, 7), (60, [0.125] * 8, 7), (61, [0.0] * 8, 7), (62, [-0.0] * 8, 7),
        (63, [1.0, 2.0], 8), (64, [], 8),
    ]
    assert compressed(rows) == brute(rows)


@pytest.mark.parametrize("big", [1e6, 1e12, 1e38, 1e200])
def test_large_components_stay_exact(compressed, big):
    rows = rows_of(40, 11) + rows_of(3, 12, spread=big) + [(99, [big] * 8, 1), (100, [big] * 7 + [0.0], 1), (101, [-big] * 8, 2)]
    rows = [(i, r[1], r[2]) for i, r in enumerate(rows)]
    assert compressed(rows) == brute(rows)


def test_nothing_usable(compressed):
    assert compressed([(1, None, 1), (2, [float("nan")] * 8, 1)]) == []
    assert compressed([]) == []


@pytest.mark.parametrize("entries", [1, 5, 64, 65, 256])
def test_slices_give_the_nearest_entry(entries):
    state = np.random.default_rng(entries)
    for spread in (3, 1000):
        book = state.integers(-spread, spread, (entries, 6))
        x = state.integers(-spread, spread, (500, 6))
        squares = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        entry, least = V.Slices(book).nearest(x)
        assert (entry == squares.argmin(axis=1)).all() and (least == squares.min(axis=1)).all()


def test_masks_leave_few_candidates():
    """The intersected slices must hold every entry within the radius, and far fewer than all."""
    state = np.random.default_rng(1)
    book = state.normal(0, 500, (256, 4)).astype(np.int64)
    x = book[state.integers(0, 256, 400)] + state.integers(-40, 40, (400, 4))
    slices = V.Slices(book)
    row, entry = slices.candidates(x, slices.first_radius(x))
    squares = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    pairs = set(zip(row.tolist(), entry.tolist()))
    assert all((i, int(k)) in pairs for i, k in enumerate(squares.argmin(axis=1)))
    assert len(row) < 0.25 * squares.size
