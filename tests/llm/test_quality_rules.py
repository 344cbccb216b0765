import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.oracle import compare, connect
from tidemark.llm import quality_rules as Q


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_verdicts_and_edges(spark, documents, edge_rows):
    got = Q.judge(documents(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    want = Counter((i, *by_hand(t)) for i, t in edge_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    verdict = {r.doc_id: r for r in got}
    assert not verdict[2].kept and verdict[2].base_failed
    assert verdict[5].base_failed and verdict[5].n_words == 60_000
    assert verdict[6].kept and not verdict[6].base_failed
    assert not verdict[10].kept
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.rejected_by is None) and not (r.base_failed and r.kept)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_windows(words):
    text = b" ".join(words).decode()
    assert Q.words_in_repeats(words) == by_hand(text)[4]


def test_equal_keys_of_different_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(Q, "_BASE", Q.np.uint64(0))  # keys keep the last word only
    words = [bytes([97 + i % 7]) for i in range(40)] + [b"z"] * 3
    assert Q.words_in_repeats(words) == by_hand(b" ".join(words).decode())[4]


def test_order_follows_rejection_per_cost_and_not_the_verdict(spark, documents):
    calls = []

    def slow(t):
        return sum(range(20_000)) < 0

    def cheap(t):
        calls.append(1)
        return t.n_words < 30

    rules = [Q.Rule("slow", slow), Q.Rule("cheap", cheap)]
    docs = documents([(i, "word " * (i % 60)) for i in range(200)])
    assert [r.name for r in Q.ordered(docs, rules)] == ["cheap", "slow"]
    assert Q.first_rejecting(Q.Text("few"), [rules[1], Q.Rule("never", lambda t: 1 / 0)]) == "cheap"
    one = Q.judge(docs, rules, report=()).where("kept").count()
    assert one == Q.judge(docs, rules[::-1], report=()).where("kept").count() == sum(i % 60 >= 30 for i in range(200))


def test_keep_returns_whole_rows_and_empty_tables_work(spark, documents, edge_rows):
    docs = documents(edge_rows)
    kept = Q.keep(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(
        r.doc_id for r in Q.judge(docs).where("kept").collect() if r.doc_id
    )
    empty = documents([]).where("false")
    assert Q.judge(empty).collect() == [] and Q.keep(empty).collect() == []


def test_sql_twin(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    name = "op1_quality_rules"
    assert compare(spark, connect(sf_dir), name, QUERIES[name], Q.SQL, sf_dir) is None


@pytest.mark.parametrize("quality,least", [(1, 0.95), (0, None)])
def test_clean_documents_stay(spark, sf_dir, quality, least):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"quality = {quality}")
    got = Q.judge(docs).join(labels, "doc_id").where("n_words >= 20").collect()
    share = sum(r.kept for r in got) / len(got)
    assert share >= least if least else share <= 0.3
