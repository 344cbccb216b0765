import re

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import prose
from tidemark.llm import simhash as S


def print_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, distance):
    """Smallest position that each reaches over links of at most ``distance`` bits."""
    root = list(range(len(prints)))
    moved = True
    while moved:
        moved = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and root[j] > root[i]:
                    root[j], moved = root[i], True
    return root


def signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.fixture(scope="module")
def words():
    """Fingerprints in clusters: chains of one- to three-bit steps, balls round a centre, and others."""
    rng = np.random.default_rng(5)
    out = [int(x) for x in rng.integers(0, 1 << 63, 40, dtype=np.uint64)]
    centre = out[0] | 1 << 63
    out += [centre] + [centre ^ (1 << int(b)) for b in rng.choice(64, 30, replace=False)]
    step = out[1]
    for _ in range(25):
        for b in rng.choice(64, int(rng.integers(1, 4)), replace=False):
            step ^= 1 << int(b)
        out.append(step)
    return sorted(set(out))


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
@pytest.mark.parametrize("bucket", [0, 2, 64])
def test_groups_equal_all_pairs(spark, words, distance, bucket):
    rows = [(i, signed(w)) for i, w in enumerate(words)]
    prints = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    got = {r.fingerprint: r.component_id for r in S.groups(prints, distance, bucket).collect()}
    if distance > 2 and bucket != 64:
        words, rows = words[:], rows[:]
    assert got == {signed(w): r for w, r in zip(words, groups_by_hand(words, distance))}


def test_small_buckets_give_every_link(spark, words):
    prints = spark.createDataFrame([(signed(w),) for w in words], "fingerprint long")
    got = {(r.one, r.two) for r in S.links(prints, 2, 10**6).collect()}
    assert got == {
        tuple(sorted((signed(a), signed(b)))) for a in words for b in words if a < b and (a ^ b).bit_count() <= 2
    }


def test_a_crowd_gives_links_in_proportion(spark):
    rng = np.random.default_rng(2)
    crowd = {int(sum(1 << int(b) for b in rng.choice(20, 3, replace=False))) for _ in range(600)}
    prints = spark.createDataFrame([(w,) for w in crowd], "fingerprint long")
    assert S.links(prints, 2, 16).count() <= 65 * len(crowd)


def test_fingerprints_and_edges(spark, documents, edge_rows):
    near = prose(20, 900)
    rows = [*edge_rows, (30, near), (31, near.replace("quiet", "Quiet", 1)), (32, near + " tail"), (33, "a b"), (34, "a b c")]
    got = S.near_duplicates(documents(rows)).collect()
    assert len(got) == len(rows)
    prints = [print_by_hand(t) for _, t in rows]
    assert sorted(r.fingerprint for r in got) == sorted(f"{p:016x}" for p in prints)
    reach = groups_by_hand(prints, 2)
    ids = {}
    for (doc_id, _), root in zip(rows, reach):
        ids.setdefault(root, []).append(doc_id)
    least = {root: min((i for i in x if i is not None), default=None) for root, x in ids.items()}
    want = sorted((i or 0, least[root] or 0) for (i, _), root in zip(rows, reach))
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == want
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3) or r.fingerprint == "0" * 16} == {1}


def test_keep_one(spark, documents, edge_rows):
    docs = documents(edge_rows)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 8, 10, 11, 12] and ids.count(None) == 2


def test_long_texts_are_counted_whole():
    text = prose(3, 700) + " " + prose(4, 2000)
    assert S.fingerprint_of(text) == print_by_hand(text)


def test_empty_table(spark, documents):
    empty = documents([]).where("false")
    assert S.near_duplicates(empty).collect() == [] and S.keep_one(empty).collect() == []


def test_keep_one_where_ids_repeat_or_are_null(spark, documents):
    a, b, c, d = (prose(k, 300) for k in (21, 22, 23, 24))
    copy = b.replace(b.split()[0], b.split()[0].upper(), 1)
    assert S.fingerprint_of(b) == S.fingerprint_of(copy)
    rows = [(5, a), (5, b), (3, copy), (None, c), (None, c), (7, d), (None, d), (5, a)]
    kept = sorted((r.doc_id or 0, r.text) for r in S.keep_one(documents(rows)).collect())
    assert kept == sorted([(5, a), (3, copy), (0, c), (7, d)])
