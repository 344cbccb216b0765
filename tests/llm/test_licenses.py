import re
from collections import Counter

import pytest

from tidemark.llm import licenses as L


def by_hand(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", "no licence", "MIT License", "the MIT\n-- License, and mit license mit license apache license",
    "Apache License, Version 2.0\nGNU General Public License général public license",
    "İMIT license ﬁ mit licensed", "x " * 5000 + "General  Public\tLicense " + "y " * 5000,
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause\ncode",
    "/* SPDX-License-Identifier: AND MIT */", "Licensed under CC BY-NC 4.0.",
]


def test_base_places_equal_a_plain_search(spark, documents, edge_rows):
    rows = [*enumerate(TEXTS, 100), *edge_rows]
    got = L.scan(documents(rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(
        (i, *by_hand(t)) for i, t in rows
    )
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))
    by_id = {r.doc_id: r for r in got}
    assert by_id[108].labels == "bsd-3-clause,gpl-2.0-only with classpath-exception-2.0,mit"
    assert by_id[108].score == 0.1
    assert by_id[109].labels == L.INVALID
    assert by_id[110].labels == "cc-by,cc-by-nc"
    assert by_id[100].labels == "" and by_id[100].score == 0


@pytest.mark.parametrize(
    "expression,labels,restriction",
    [
        ("MIT", {"mit"}, 0.1),
        ("MIT or GPL-3.0-only", {"mit", "gpl-3.0-only"}, 0.1),
        ("MIT AND GPL-3.0-only", {"mit", "gpl-3.0-only"}, 0.7),
        ("MIT OR Apache-2.0 AND GPL-2.0+", {"mit", "apache-2.0", "gpl-2.0+"}, 0.1),
        ("(MIT OR Apache-2.0) AND GPL-2.0+", {"mit", "apache-2.0", "gpl-2.0+"}, 0.7),
        ("((GPL-2.0 WITH x-exception))", {"gpl-2.0 with x-exception"}, 0.7),
    ],
)
def test_expressions(expression, labels, restriction):
    assert L.evaluate(expression) == (labels, restriction)


@pytest.mark.parametrize(
    "expression", ["", "AND", "MIT AND", "(MIT", "MIT)", "MIT MIT", "()", "MIT WITH", "(a or b) with c", "MIT / x"]
)
def test_malformed_expressions(expression):
    with pytest.raises(ValueError):
        L.evaluate(expression)


def test_empty_table(spark, documents):
    assert L.scan(documents([]).where("false")).collect() == []


@pytest.mark.parametrize(
    "text,labels",
    [
        ("SPDX-License-Identifier: GPL-3.0-only Copyright 2020 X", [{"gpl-3.0-only"}]),
        ("<td>SPDX-License-Identifier: MIT</td>", [{"mit"}]),
        ('"SPDX-License-Identifier: MIT", x', [{"mit"}]),
        ("SPDX-License-Identifier: MIT OR Apache-2.0. Then prose", [{"mit", "apache-2.0"}]),
        ("SPDX-License-Identifier: MIT and the rest", [{"mit"}]),
        ("SPDX-License-Identifier: MIT SPDX-License-Identifier: (BSD-3-Clause) y", [{"mit"}, {"bsd-3-clause"}]),
        ("SPDX-License-Identifier: AND MIT", [{L.INVALID}]),
        ("SPDX-License-Identifier: (MIT", [{L.INVALID}]),
    ],
)
def test_text_after_a_tagged_expression_ends_it(text, labels):
    assert [t.labels for t in L.tag_terms(text)] == labels


def test_very_long_texts_take_time_in_proportion():
    """10 MB of phrases and a 1 MB expression: seconds, and memory of the text's order."""
    import time
    import tracemalloc

    text = "this is under the mit license and the general public license \n" * 160_000
    start = time.process_time()
    found = L.scan_text(text, L.automaton())
    assert time.process_time() - start < 10
    assert found["n_base"] == 320_000 and found["base_labels"] == "gpl,mit"
    words = text.split()
    assert (found["first_word"], found["last_word"]) == (words.index("mit"), len(words) - 3)
    operands = [f"lic{k}-x" for k in range(90_000)]
    for joint in (" OR ", " AND ", " WITH "):
        tracemalloc.start()
        start = time.process_time()
        (terms,) = L.tag_terms("SPDX-License-Identifier: " + joint.join(operands) + " ) and so on")
        assert time.process_time() - start < 10 and tracemalloc.get_traced_memory()[1] < 100e6
        tracemalloc.stop()
        assert len(terms.labels) == (1 if joint == " WITH " else 90_000)


@pytest.mark.parametrize(
    "text, end",
    [
        ("MIT", 3), ("MIT OR", 3), ("(MIT OR Apache-2.0) AND BSD-3-Clause.", 36), ("(MIT", 0), ("(MIT) WITH (A OR B)", 5),
        ("A OR (B OR C) WITH x", 13), ("(A OR A) WITH x", 15), ("A WITH b WITH c)", 15), ("MIT and others", 3), ("", 0), ("!", 0),
    ],
)
def test_longest_expression(text, end):
    assert L.expression_end(text) == end
