"""Counts and probabilities against plain Python, held-out accuracy, odd rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import toxicity as X

INSULTS = ["blorgface", "blorghead", "zwunkish", "zwunkling", "zwunkery", "blorgy"]


def rows_of(n):
    """Texts of which every fifth holds invented insults, some endings being rare."""
    docs, labels = [], []
    for i in range(n):
        text, toxic = prose(i), int(i % 5 == 0)
        if toxic:
            words = text.split(" ")
            for k in range(4, len(words), 12):
                words[k] = INSULTS[(i // 5 + k) % len(INSULTS)]
            text = " ".join(words)
        docs.append((i, text))
        if i % 3:
            labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture
def label_table(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def grams_of(word):
    s = X.EDGE * X.CONTEXT + word + X.END
    return [s[i : i + X.CONTEXT + 1] for i in range(len(s) - X.CONTEXT)]


def brute_counts(docs, labels):
    known = {}
    for i, _, toxic in labels:
        if toxic in (0, 1) and i is not None and zlib.crc32(str(i).encode()) % 5 > 1:
            known[i] = max(known.get(i, 0), toxic)
    counts = defaultdict(Counter)
    for i, text in docs:
        for word in set(X.words_of(text)):
            for g in grams_of(word):
                counts["every"][g] += 1
                if i in known:
                    counts["toxic" if known[i] else "plain"][g] += 1
    return counts


def brute_diffs(counts):
    """Interpolated Kneser-Ney by the textbook, one dictionary a level."""
    levels = [counts["every"]]
    for _ in range(X.CONTEXT):
        levels.append(Counter(g[1:] for g in levels[-1]))
    total = sum(levels[-1].values())
    p = {g: n / total for g, n in levels[-1].items()}
    for level in reversed(levels[:-1]):
        sums, kinds = Counter(), Counter()
        for g, n in level.items():
            sums[g[:-1]] += n
            kinds[g[:-1]] += 1
        p = {g: (n - X.DISCOUNT + X.DISCOUNT * kinds[g[:-1]] * p[g[1:]]) / sums[g[:-1]] for g, n in level.items()}
    least = min(sum(counts[c].values()) for c in ("toxic", "plain"))
    own = {}
    for c in ("toxic", "plain"):
        size = least / sum(counts[c].values())
        sums, freed = Counter(), Counter()
        for g, n in counts[c].items():
            sums[g[:-1]] += n * size
            freed[g[:-1]] += min(n * size, X.DISCOUNT)
        own[c] = {
            g: (max(counts[c][g] * size - X.DISCOUNT, 0) + freed[g[:-1]] * p[g]) / sums[g[:-1]] if sums[g[:-1]] else p[g]
            for g in p
        }
    return {g: math.log(own["toxic"][g]) - math.log(own["plain"][g]) for g in p}, p


def test_counts_and_probabilities_equal_the_textbook(spark, documents, label_table):
    docs, labels = rows_of(120)
    docs += [(5, docs[5][1]), (None, "unlabelled words"), (900, None), (901, "")]
    labels += [(5, 1, 0), (7, 1, 3), (8, 0, None), (None, 1, 1)]
    known = X.one_label(label_table(labels)).where(X.fold(X.F.col("doc_id")) != X.CURVE)
    grams = X.count(X.with_labels(documents(docs), known, ["text"]).select("text", "toxic"))
    want = brute_counts(docs, labels)
    got = {r.gram: r for r in grams.collect()}
    assert set(got) == set(want["every"])
    for c in ("every", "toxic", "plain"):
        assert all(got[g][c] == want[c][g] for g in got)
    diffs, _ = brute_diffs(want)
    found = {r.gram: r.diff for r in X.differences(grams).collect()}
    assert found.keys() == diffs.keys()
    assert all(found[g] == pytest.approx(diffs[g], abs=1e-9) for g in diffs)


def test_probabilities_sum_to_one():
    docs, labels = rows_of(60)
    _, p = brute_diffs(brute_counts(docs, labels))
    sums = Counter()
    for g, v in p.items():
        sums[g[:-1]] += v
    assert max(sums.values()) <= 1 + 1e-9


def test_held_out_rows_are_told_apart(documents, label_table):
    docs, labels = rows_of(900)
    rows = X.score(documents(docs), label_table(labels)).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = [r.doc_id for r in held if r.predicted != int(r.doc_id % 5 == 0)]
    assert len(wrong) <= 0.03 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_change_nothing(documents, label_table):
    docs, labels = rows_of(150)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    first, second = ({r.doc_id: r.score for r in X.score(documents(docs), label_table(x)).collect()} for x in (labels, turned))
    assert first == pytest.approx(second, abs=1e-12)


def test_new_endings_of_known_insults():
    """A word never seen shares its first characters with insults: backing off tells it."""
    docs, labels = rows_of(600)
    diffs, _ = brute_diffs(brute_counts(docs, labels))
    table = np.zeros(1 << X.SLOT_BITS, np.float32)
    for g, d in diffs.items():
        codes = np.frombuffer(g.encode("utf-32-le"), np.uint32)
        table[X.slots(X.keys(codes, np.zeros(1, np.int64)))] = d
    scorer = X.Scorer(table)
    (unseen,), (plain,) = scorer([["blorgish"]]), scorer([["river"]])
    assert unseen > 1 > 0.2 > plain


def test_odd_rows(documents, label_table, edge_rows):
    docs, labels = rows_of(200)
    rows = X.score(documents(docs + [(5000 + k, t) for k, (_, t) in enumerate(edge_rows)] + [(None, None), (None, "x")]), label_table(labels)).collect()
    assert len(rows) == len(docs) + len(edge_rows) + 2
    empty = {r.score for r in rows if r.doc_id in (5000, 5001, 5002)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert all(r.score is not None for r in rows)


def test_without_both_classes(documents, label_table):
    docs, labels = rows_of(40)
    for some in ([], [r for r in labels if not r[2]]):
        rows = X.score(documents(docs), label_table(some)).collect()
        assert len(rows) == 40 and {(r.score, r.predicted) for r in rows} == {(0.0, 0)}
    assert X.score(documents(docs).where("doc_id < 0"), label_table(labels)).count() == 0


def test_counts_without_labels(documents):
    docs, _ = rows_of(30)
    texts = documents(docs).selectExpr("text", "cast(null as int) as toxic")
    whole = {r.gram: r.every for r in X.count(texts).collect()}
    assert whole == dict(brute_counts(docs, [])["every"])
