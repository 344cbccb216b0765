import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing, token_files
from tidemark.llm.tokens import Encoder, _load, tokenizer_path

ENCODE = Encoder(tokenizer_path())
LIBRARY = _load(tokenizer_path())
TRICKY = " \n\t\r\x0b\x0c\x1c\x85\xa0 　aB'sdlévß09.,!?;:-|%<>&ʼœΩжक़中😀"


def whole(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=1000, deadline=None)
@given(st.one_of(st.text(alphabet=TRICKY, max_size=40), st.text(max_size=60)))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == whole(text)[:-1]


def test_a_small_memory_changes_nothing(monkeypatch):
    from tidemark.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    encode = Encoder(tokenizer_path())
    text = "one two three, four five. six one two three <|endoftext|> four  five\n\nsix " * 3
    assert np.frombuffer(encode(text), "<u4").tolist() == whole(text)[:-1]


def test_packing_places_every_piece_once(spark, documents, edge_rows):
    got = packing.pack(documents(edge_rows)).collect()
    texts = [whole(t) for _, t in edge_rows]
    assert sum(r.length for r in got) == sum(map(len, texts))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in edge_rows:
        if [i for i, _ in edge_rows].count(doc_id) > 1:
            continue
        ids, pieces = np.array(whole(text), "<u4"), sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        assert all(r.length == 1024 for r in pieces[1:])
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length])
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing_an_empty_table(spark, documents):
    assert packing.pack(documents([]).where("false")).collect() == []


def fill(slots):
    bins = defaultdict(list)
    for s in slots:
        for k in range(s.count):
            bins[s.sequence + k].append((s.offset, s.length))
    return bins


def first_fit(counts, capacity):
    """Bins that first-fit in descending order opens."""
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = next((i for i, g in enumerate(gaps) if g >= length), None)
            if at is None:
                gaps.append(capacity - length)
            else:
                gaps[at] -= length
    return len(gaps)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 30), max_size=25))
def test_plan_is_gapless_and_pairs_large_pieces_at_most(counts):
    slots = packing.plan(counts, 100)
    ranks = defaultdict(list)
    for s in slots:
        ranks[s.length] += range(s.rank, s.rank + s.count)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    bins = fill(slots)
    for spans in bins.values():
        spans.sort()
        assert [o for o, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])
        assert sum(n for _, n in spans) <= 100
        assert sum(3 * n > 100 for _, n in spans) <= 2
    assert len(bins) <= first_fit(counts, 100) + 1


def test_plan_grows_with_lengths_not_with_rows():
    counts = {n: 10**9 + n for n in range(1, 1025)}
    slots = packing.plan(counts)
    assert len(slots) < 50_000
    bins = max(s.sequence + s.count for s in slots)
    assert bins < 1.01 * sum(n * c for n, c in counts.items()) / 1024


@pytest.mark.parametrize("sequence", [8, 1024])
def test_token_files_round_trip(spark, documents, edge_rows, tmp_path, sequence):
    rows = [r for r in edge_rows if r[0] not in (8, None)] + [(0, "zero"), (-5, "minus")]
    folder = str(tmp_path / "tokens")
    got = {r.doc_id: r for r in token_files.round_trip(documents(rows), folder, sequence).collect()}
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array(whole(text), "<u4")
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_sequences_are_views_of_the_file(spark, documents, tmp_path):
    folder = str(tmp_path / "tokens")
    rows = [(i, "some words here " * (i + 1)) for i in range(200)]
    manifest = token_files.write(documents(rows), folder, 256).collect()
    found = []
    for m in sorted(manifest):
        file = token_files.TokenFile(folder, m.file, 256)
        before = pa.total_allocated_bytes()
        count = -(-m.ids // 256)
        parts = [file.sequence_at(k) for k in range(count)]
        assert all(len(ids) == 256 for ids, _ in parts)
        # ids stay in the mapped file; only the masks are unpacked, to a byte each
        assert pa.total_allocated_bytes() - before <= 256 * count
        ids = np.concatenate([i for i, _ in parts])
        mask = np.concatenate([x for _, x in parts])
        assert mask.sum() == m.ids and mask[: m.ids].all()
        assert sum(file.sequences.get_batch(k).num_rows for k in range(file.sequences.num_record_batches)) == count
        found += ids[mask].tolist()
    assert found == [i for _, t in rows for i in whole(t)]


def test_repeated_and_missing_ids_are_all_written(spark, documents, edge_rows, tmp_path):
    got = token_files.round_trip(documents(edge_rows), str(tmp_path / "t")).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in got) == sorted(
        (i is not None, i or 0, len(whole(t))) for i, t in edge_rows
    )
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    empty = documents([]).where("false")
    assert token_files.round_trip(empty, str(tmp_path / "none")).collect() == []


def test_rows_of_one_id_are_dealt_out_and_packed_once_each(spark):
    """Nine in ten rows lack an id, most of them one row repeated."""
    rows = [(None if i % 10 else i, "the same words" if i % 5 else f"words {i}") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    pieces = packing.checkpointed(packing.pieces_of(docs))
    sizes = [r["count"] for r in packing.deal(pieces, 8).groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 300
    got = packing.pack(docs).collect()
    assert len(got) == 2_000
    ends: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= packing.CAPACITY
    total = sum(r.length for r in got)
    assert len(ends) == -(-total // packing.CAPACITY)
