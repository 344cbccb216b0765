import zlib

import pytest

import corpus_pipeline as P
from tests.llm.conftest import prose
from tidemark.llm import packing, quality_rules, simhash


@pytest.fixture
def stored(spark, documents, tmp_path):
    def store(rows):
        folder = tmp_path / "sf"
        documents(rows).write.parquet(str(folder / "documents.parquet"))
        return str(folder)

    return store


def test_stages_take_effect_in_order(spark, stored, documents):
    near = prose(500, 900)
    rows = [(i, prose(i, 120)) for i in range(1, 80)]
    rows += [(200, near), (201, near), (202, near.replace("quiet", "Quiet", 1)), (203, "short"), (204, "### $$$ %%% | " * 60), (None, prose(90, 120))]
    sf_dir = stored(rows)
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in P.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == spark.read.parquet(f"{sf_dir}/documents.parquet").columns, name
        kept.append({r.doc_id for r in docs.collect()})
        assert kept[-1] <= before
    assert {203, 204}.isdisjoint(kept[0]) and {200, 201, 202} <= kept[0]
    assert kept[1] == kept[0]  # nothing left to reject
    assert kept[2] & {200, 201, 202} == {200} and None in kept[2]
    assert kept[3] < kept[2]
    pieces = P.run(spark, sf_dir).collect()
    assert {r.doc_id for r in pieces} == kept[3]
    texts = dict(rows)
    whole = [r for r in pieces if r.piece == 0 and r.start == 0 and r.doc_id is not None]
    from tidemark.llm.tokens import Encoder, tokenizer_path

    encode = Encoder(tokenizer_path())
    for r in whole:
        ids = encode(texts[r.doc_id]) + (2).to_bytes(4, "little")
        assert r.ids_crc32 == zlib.crc32(ids[: 4 * r.length])


def test_stages_equal_their_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality_rules.judge(docs).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in P.rules(spark, docs, sf_dir).select("doc_id").collect()) == sorted(
        r.doc_id for r in judged.collect()
    )
    found = simhash.near_duplicates(docs).where("doc_id = component_id")
    assert P.near_duplicates(spark, docs, sf_dir).count() == found.count()
    assert P.pack(spark, docs, sf_dir).count() == packing.pieces_of(docs).count()


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")]])
def test_tables_that_leave_nothing(spark, stored, rows):
    assert P.run(spark, stored(rows)).collect() == []


def test_stage_list():
    assert len(P.STAGES) == 5 and all(callable(f) for _, f in P.STAGES)
