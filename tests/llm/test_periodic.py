"""Periodic runs against brute force, and checksums of whole texts."""

import hashlib
import random
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periodic


def brute_runs(w):
    """Every stretch with every period, straight from the definition."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            part = w[s : s + length]
            smaller = any(part[r:] == part[:-r] for r in range(1, q))
            if length >= max(12, 2 * q) and not smaller:
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_words(text):
    words, word = [], ""
    for c in text or "":
        if c in " \t\n\v\f\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    return words + [word] * bool(word)


def brute_row(doc_id, text):
    w = brute_words(text)
    if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0 and w:
        g, n = zlib.crc32(str(doc_id).encode()) // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9), st.integers(0, 50))
def test_runs_equal_brute_force(letters, period, tail):
    words = [b"abc"[x : x + 1] for x in letters]
    words += [words[-period:][i % min(period, len(words))] for i in range(tail)] if words else []
    assert periodic.runs_of(words) == brute_runs(words)


def test_nested_and_overlapping_runs():
    inner = [b"a", b"a", b"a", b"b"]
    words = (inner * 4 + [b"x"]) * 3 + [b"y"] + [b"z"] * 13
    assert periodic.runs_of(words) == brute_runs(words)
    assert len(brute_runs(words)) >= 4


def test_query_equals_brute_force(spark, documents, edge_rows):
    state = random.Random(7)
    ids = [i for i in range(20, 400) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    made = [(i, " ".join(state.choice(["x", "yy", "zzz"]) for _ in range(state.randrange(1, 90)))) for i in ids]
    made += [(1000, "a b c d e\x1ff  g"), (1001, "tab\tvert\x0bform\x0cret\rline\n"), (1002, "one " * 11), (1003, "one " * 12)]
    rows = [r for r in edge_rows if len(r[1] or "") < 50_000] + made
    names = [f.split()[0] for f in periodic.SCHEMA.split(", ")]
    got = [tuple(r[n] for n in names) for r in periodic.digest(documents(rows)).collect()]
    assert sorted(got, key=str) == sorted((brute_row(i, t) for i, t in rows), key=str)


def test_spans_and_shortened_text(documents):
    text = "start " + "one two three " * 6 + "end"
    row = periodic.detect(documents([(1, text)])).first()
    assert [(r.start, r.length, r.period) for r in row.runs] == [(1, 18, 3)]
    assert row.collapsed == "start one two three end"


def test_empty_table(documents):
    assert periodic.digest(documents([(1, "a")]).where("doc_id > 1")).count() == 0


@pytest.mark.parametrize("kind", ["one word", "period", "lines", "two words"])
def test_very_long_texts_in_time(kind):
    state = random.Random(1)
    if kind == "one word":
        words, runs = [b"a"] * 500_000, 1
    elif kind == "period":
        words, runs = [b"%d" % (i % 977) for i in range(500_000)], 1
    elif kind == "lines":
        words = [b"%d.%d" % (k, i) for k in (state.randrange(10) for _ in range(30_000)) for i in range(12)]
        runs = None
    else:
        words, runs = [b"%d" % state.randrange(2) for _ in range(200_000)], None
    start = time.process_time()
    found = periodic.runs_of(words)
    assert time.process_time() - start < 20
    assert runs is None or len(found) == runs
