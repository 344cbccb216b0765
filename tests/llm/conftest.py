import pytest

LONG = "alpha beta gamma " * 20_000
PROSE = "The river and the road go to the old town in the hills. It is a quiet place.\n" * 1
CLASHING = {
    "n_words": "string", "kept": "int", "component_id": "string", "fingerprint": "int", "rank": "int",
    "part": "int", "length": "string", "score": "string", "topic": "string", "rule": "string", "word": "string",
}


def prose(k: int, words: int = 60) -> str:
    """Distinct sentences, deterministic in ``k``."""
    vocabulary = "the of and river road town hill quiet place house garden window letter morning evening story".split()
    out, state = [], k * 7919 + 13
    for i in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        word = vocabulary[(state >> 8) % len(vocabulary)] + ("" if (state >> 16) % 3 else chr(97 + (state >> 20) % 26))
        out.append(word + (".\n" if i % 12 == 11 else ""))
    return " ".join(out) + "."


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (id, text) rows, with source, lang and columns whose names clash."""

    def make(rows):
        full = [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}", 0) for i, t in rows]
        docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        for name, kind in CLASHING.items():
            docs = docs.selectExpr("*", f"CAST(1 AS {kind}) AS {name}")
        return docs.repartition(3)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, LONG), (6, prose(6)), (7, prose(6)),
        (8, prose(8)), (8, prose(8)), (None, prose(9)), (None, None), (10, "###### %%% $$$ | | | <<< >>>" * 5),
        (11, "same line\n" * 40), (12, "Ünïcödé wörds 中文 текст  x " * 30),
    ]
