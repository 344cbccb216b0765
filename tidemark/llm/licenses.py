"""Licence scan: notice phrases and identifier tags by one automaton, expressions by precedence.

Texts are lower-cased in A-Z and cut into words of digits, letters and all characters beyond ASCII.
An Aho-Corasick automaton over the words finds notice phrases and the tag that precedes a licence
expression. The longest expression behind each tag, up to the line's end, goes through a shunting-yard
parser; text after it ends it. ``with`` binds
before ``and``, ``and`` before ``or``.

The score says how far the findings restrict use, from 0 (nothing found) to 1: a choice (``or``)
counts its mildest side, a conjunction its strictest, and a document its strictest finding.
Null and empty texts have no words, no labels (empty strings) and score 0; repeated rows and null
ids are scanned like any other; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame

from tidemark.llm.common import map_batches

# fixed values: the phrases and labels that every scan reports
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

# how far a family restricts use; the first prefix that fits counts, unknown ones stand between
RESTRICTION = {
    "cc0": 0.05, "unlicense": 0.05, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "apache": 0.15,
    "cc-by-nc": 0.9, "cc-by-nd": 0.9, "cc-by-sa": 0.6, "cc-by": 0.2, "mpl": 0.4, "epl": 0.4,
    "lgpl": 0.5, "agpl": 0.8, "gpl": 0.7, "all-rights-reserved": 1.0,
}
UNKNOWN = 0.5
INVALID = "invalid-expression"

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_TAG = re.compile(r"(?i)spdx[^0-9A-Za-z\n]+license[^0-9A-Za-z\n]+identifier[^0-9A-Za-z(\n]*")
_TOKEN = re.compile(r"[()]|[0-9A-Za-z.+:-]+|\S")
_BINDS = {"or": 1, "and": 2, "with": 3}


class Terms(NamedTuple):
    """Labels an expression names, and how far it restricts use."""

    labels: frozenset[str]
    restriction: float


def restriction(label: str) -> float:
    return next((v for k, v in RESTRICTION.items() if label.startswith(k)), UNKNOWN)


class _Value:
    """An operand while it is put together: one label, as the parts that ``with`` joins, or several."""

    def __init__(self, label: str) -> None:
        self.parts: list[str] | None = [label]
        self.many: set[str] = set()
        self.restriction = restriction(label)

    def labels(self) -> set[str]:
        return {" with ".join(self.parts)} if self.parts is not None else self.many

    def join(self, operator: str, other: _Value) -> _Value:
        """Both operands as one; the smaller set of labels goes into the larger."""
        if operator == "with":
            if self.parts is None or other.parts is None:
                raise ValueError("an exception belongs to one licence")
            self.parts += other.parts
            return self
        large, small = sorted((self.labels(), other.labels()), key=len, reverse=True)
        large |= small
        self.parts, self.many = (list(large), set()) if len(large) == 1 else (None, large)
        choose = min if operator == "or" else max
        self.restriction = choose(self.restriction, other.restriction)
        return self


class _Parser:
    """Shunting-yard: operands and operators on stacks, a token at a time; ValueError where one cannot follow."""

    def __init__(self) -> None:
        self.values: list[_Value] = []
        self.operators: list[str] = []
        self.operand_next = True

    def _reduce(self) -> None:
        two, one = self.values.pop(), self.values.pop()
        self.values.append(one.join(self.operators.pop(), two))

    def add(self, token: str) -> None:
        if token == "(" or token not in _BINDS and token != ")":
            if not self.operand_next:
                raise ValueError(f"operator expected before {token}")
            if token == "(":
                self.operators.append(token)
                return
            if not token[0].isalnum():
                raise ValueError(f"not a licence: {token}")
            self.values.append(_Value(token))
            self.operand_next = False
            return
        if self.operand_next:
            raise ValueError(f"licence expected before {token}")
        if token == ")":
            while self.operators and self.operators[-1] != "(":
                self._reduce()
            if not self.operators:
                raise ValueError("unbalanced parentheses")
            self.operators.pop()
            return
        while self.operators and _BINDS.get(self.operators[-1], 0) >= _BINDS[token]:
            self._reduce()
        self.operators.append(token)
        self.operand_next = True

    def complete(self) -> bool:
        """Whether what was read is an expression; parentheses are the caller's to count."""
        if self.operand_next:
            return False
        # only a pending ``with`` can still fail: its operands must be one label each
        return not self.operators or self.operators[-1] != "with" or all(v.parts is not None for v in self.values[-2:])

    def result(self) -> Terms:
        if self.operand_next or "(" in self.operators:
            raise ValueError("incomplete expression")
        while self.operators:
            self._reduce()
        return Terms(frozenset(self.values[0].labels()), self.values[0].restriction)


def evaluate(expression: str) -> Terms:
    """Value of a licence expression; ValueError where it is malformed."""
    parser = _Parser()
    for token in _TOKEN.findall(expression.lower()):
        parser.add(token)
    return parser.result()


def expression_end(text: str) -> int:
    """Where the longest expression that a text begins with ends; 0 where it begins with none.

    One pass: the parser reads on until no token can follow, and the last place where it had a whole
    expression counts. Behind an operator in small letters a plain word is prose, unless it names a known family.
    """
    parser, depth, small, end = _Parser(), 0, False, 0
    for match in _TOKEN.finditer(text):
        token = match[0].rstrip(".:") or match[0]
        low = token.lower()
        if parser.operand_next:
            prose = small and re.fullmatch("[a-z]+", low) and restriction(low) == UNKNOWN
            if token != "(" and (low in _BINDS or not token[0].isalnum() or prose):
                break
            depth += token == "("
        elif token == ")" and depth:
            depth -= 1
        elif low in _BINDS and token == match[0]:
            small = token.islower()
        else:
            break
        try:
            parser.add(low)
        except ValueError:
            break
        if not depth and not parser.operand_next:
            if not parser.complete():
                break
            end = match.start() + len(token)
        if not parser.operand_next and token != match[0]:  # a mark ends the sentence
            break
    return end


def tag_terms(text: str) -> list[Terms]:
    """Values of the expressions behind the tags of a text; one that is none has a label of its own."""
    found = []
    tags = list(_TAG.finditer(text))
    for tag, stop in zip(tags, [*[t.start() for t in tags[1:]], len(text)]):
        line = text[tag.end() : stop].partition("\n")[0]
        end = expression_end(line)
        found.append(evaluate(line[:end]) if end else Terms(frozenset([INVALID]), UNKNOWN))
    return found


def automaton() -> ahocorasick.Automaton:
    """Phrases between blanks, with their number of blanks and what they stand for."""
    out = ahocorasick.Automaton()
    phrases = {p: ("base", label) for p, label in BASE_PHRASES.items()}
    phrases |= {p: ("notice", label) for p, label in NOTICES.items()}
    phrases[TAG] = ("tag", "")
    for phrase, (kind, label) in phrases.items():
        out.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
    out.make_automaton()
    return out


def scan_text(text: str | None, machine: ahocorasick.Automaton) -> dict:
    words = (text or "").encode().translate(_WORD_BYTES).split()
    base, places, terms, tagged = set(), [], {}, False
    line = f" {b' '.join(words).decode()} "
    seen_at = seen = 0  # a place in the line, and the words before it
    for end, (length, kind, label) in machine.iter(line):
        if kind == "tag":
            tagged = True
            continue
        if kind == "base":
            base.add(label)
            at = end - length + 1
            if at > seen_at:
                seen += line.count(" ", seen_at + 1, at + 1)
            else:
                seen -= line.count(" ", at + 1, seen_at + 1)
            seen_at = at
            places.append(seen)
        terms[label] = Terms(frozenset([label]), restriction(label))
    terms = [*terms.values(), *(tag_terms(text) if tagged else ())]
    labels = base.union(*(t.labels for t in terms))
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": max((t.restriction for t in terms), default=0.0),
    }


def scan(docs: DataFrame) -> DataFrame:
    """Licence findings of every document."""

    def make():
        machine = automaton()

        def step(doc_ids, texts):
            found = [scan_text(t, machine) for t in texts]
            return {"doc_id": doc_ids} | {
                c: [f[c] for f in found]
                for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
            }

        return step

    return map_batches(
        docs, ["doc_id", "text"], make,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
