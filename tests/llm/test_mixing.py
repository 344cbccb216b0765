import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import prose
from tidemark.llm import mixing as M

TARGETS = {"source": {"a": 0.5}, "lang": {"x": 0.3, "y": 0.7}}


def test_raking_meets_all_margins():
    counts = {("a", "x"): 500.0, ("a", "y"): 300.0, ("other", "x"): 900.0, ("other", "y"): 800.0}
    cells = M.rake(counts, TARGETS, 0.3)
    assert cells.margin(0) == pytest.approx({"a": 0.5, "other": 0.5})
    assert cells.margin(1) == pytest.approx({"x": 0.3, "y": 0.7})
    assert (cells.tokens * cells.probability).sum() == pytest.approx(0.3 * 2500)
    # raking keeps the interactions of the counts: cross ratios do not change
    p = dict(zip(cells.names, cells.probability))
    assert p["a", "x"] * p["other", "y"] == pytest.approx(p["a", "y"] * p["other", "x"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=4, max_size=4), st.floats(0.05, 1))
def test_probabilities_stay_probabilities(n, budget):
    names = [(s, x) for s in ("a", "other") for x in ("x", "y")]
    cells = M.rake(dict(zip(names, map(float, n))), TARGETS, budget)
    assert ((cells.probability >= 0) & (cells.probability <= 1)).all()


def test_a_value_that_is_too_small_is_drawn_whole():
    cells = M.rake({("a", "x"): 10.0, ("other", "x"): 5000.0, ("other", "y"): 5000.0}, TARGETS, 0.5)
    assert dict(zip(cells.names, cells.probability))["a", "x"] == pytest.approx(1)


def brute(rows, targets, budget):
    """Margins of the expected draw by plain sums over documents."""
    out = {}
    for d in targets:
        for r in rows:
            v = r[d] if r[d] in targets[d] else "other"
            out[d, v] = out.get((d, v), 0) + r.n_tokens * r.probability
    total = sum(r.n_tokens * r.probability for r in rows)
    return {k: v / total for k, v in out.items()}


def test_documents_are_drawn_to_the_targets(spark, documents):
    docs = documents([(i, prose(i, 40 + i % 60)) for i in range(1, 1200)])
    targets = {"source": {"src0": 0.2}, "lang": {"en": 0.6}, "topic": {"short": 1.0}}
    rows = M.weighted(docs, targets, 0.4).collect()
    margins = brute(rows, targets, 0.4)
    assert margins["source", "src0"] == pytest.approx(0.2)
    assert margins["lang", "en"] == pytest.approx(0.6)
    drawn = [r for r in rows if r.sampled]
    tokens = sum(r.n_tokens for r in drawn)
    assert tokens == pytest.approx(0.4 * sum(r.n_tokens for r in rows), rel=0.1)
    assert sum(r.n_tokens for r in drawn if r.source == "src0") / tokens == pytest.approx(0.2, abs=0.05)
    kept = M.keep(docs, targets, 0.4)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in drawn)


def test_edges(spark, documents, edge_rows):
    docs = documents(edge_rows)
    rows = M.weighted(docs).collect()
    assert len(rows) == len(edge_rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert all(0 <= r.probability <= 1 for r in rows)
    assert len({r.sampled for r in rows if r.doc_id == 8}) == 1
    empty = documents([]).where("false")
    assert M.weighted(empty).collect() == [] and M.keep(empty).collect() == []
    nothing = documents([(1, None), (2, "")])
    assert M.weighted(nothing).count() == 2


def test_share_of_large_samples_follows_the_probability(spark):
    drawn = spark.range(40_000).selectExpr("id AS doc_id", "'' AS text").select(M._drawn(7).alias("u")).toPandas().u
    assert drawn.between(0, 1, inclusive="left").all()
    assert np.abs(np.histogram(drawn, 10, (0, 1))[0] / 40_000 - 0.1).max() < 0.01


def test_no_cell_with_tokens_is_left_out_under_the_production_targets(spark, documents):
    names = [(s, x, t) for s in ("src0", "other") for x in ("en", "de", "fr", "es", "other") for t in ("short", "medium", "notice", "other")]
    cells = M.rake({c: 1000.0 + 10 * k for k, c in enumerate(names)}, M.TARGETS)
    assert (cells.probability > 0).all()
    cells = M.rake(dict(zip(cells.names, cells.tokens)), M.TARGETS, 0.2)  # so little that no cell is drawn whole
    assert (cells.probability > 0).all()
    natural = sum(n for c, n in zip(cells.names, cells.tokens) if c[1] == "other") / cells.tokens.sum()
    share = cells.margin(1)
    # the open share is the natural one, and the named ones keep their proportions
    assert share["other"] == pytest.approx(natural, rel=0.01)
    assert share["en"] / share["de"] == pytest.approx(0.56 / 0.16, rel=0.01)
    docs = documents([(i, prose(i, 40 + i % 60)) for i in range(1, 400)])
    unnamed = [r for r in M.weighted(docs).collect() if r.lang is None]
    assert all(r.probability > 0 for r in unnamed)
    assert sum(r.sampled for r in unnamed) > 0.5 * len(unnamed)


def test_a_target_of_zero_still_drops_a_value():
    cells = M.rake({("en",): 10.0, ("de",): 10.0, ("other",): 10.0}, {"lang": {"en": 1.0, "de": 0.0}}, 0.5)
    p = dict(zip(cells.names, cells.probability))
    assert p["de",] == 0 and p["en",] > 0 and p["other",] > 0


def plain_fit(docs, targets, budget):
    """Brute force: every document's probability raked one document at a time, and its draw by its own hash."""
    cells = [{d: r[d] if r[d] in targets[d] else "other" for d in targets} for r in docs]
    n = [r.n_tokens for r in docs]
    p, total = [budget] * len(docs), budget * sum(n)
    wanted = []
    for d, named in targets.items():
        there = {}
        for c, k in zip(cells, n):
            there[c[d]] = there.get(c[d], 0) + k
        share = {v: named.get(v, 0.0) for v in there}
        if "other" in there:
            share["other"] = 1 - sum(named.values())
            if share["other"] < 1e-9:  # nothing left open: the natural share
                share["other"] = there["other"] / sum(n)
                scale = (1 - share["other"]) / sum(x for v, x in share.items() if v != "other")
                share = {v: x if v == "other" else x * scale for v, x in share.items()}
        whole = sum(x for v, x in share.items() if there[v])
        wanted += [(d, v, total * share[v] / whole) for v in there if there[v]]
    for _ in range(400):
        for d, v, tokens in wanted:
            inside = [i for i, c in enumerate(cells) if c[d] == v]
            factor = tokens / sum(n[i] * p[i] for i in inside)
            for i in inside:
                p[i] = min(1.0, p[i] * factor)
    le = lambda x, size: x.to_bytes(size, "little", signed=True)
    seed = xxhash.xxh64(le(7, 4), seed=42).intdigest()
    return {r.doc_id: (q, (xxhash.xxh64(le(r.doc_id, 8), seed=seed).intdigest() >> 11) / 2**53) for r, q in zip(docs, p)}


@pytest.mark.parametrize("budget", [0.8, 0.15])
def test_probabilities_and_draws_equal_brute_force(spark, sf_dir, budget):
    """The given documents under the production targets."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = M.weighted(docs, budget=budget).collect()
    words = re.compile(r"[^\x20\x09-\x0D]+")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert [r.n_tokens for r in got] == [len(words.findall(texts[r.doc_id])) for r in got]
    want = plain_fit(got, M.TARGETS, budget)
    assert len(want) == len(got) == len(texts)
    for r in got:
        p, u = want[r.doc_id]
        assert r.probability == pytest.approx(p, rel=1e-5, abs=1e-9)
        if abs(u - p) > 1e-6:
            assert r.sampled == (u < p)
