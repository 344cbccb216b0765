"""Quality rules as a short-circuit cascade.

Each rule rejects a document by one or two measures of its text. A sample tells, per rule, the
time it takes and the share it rejects; rules then run by rejection per cost, the best first, and
a document's evaluation ends at the first that rejects it. The order changes the work and the name
of the first rejecting rule, never the verdict.

A word is a run of characters other than ASCII white space. Null and empty texts have no words and
fail the base rule. Null ids and repeated rows are judged like any other row; an empty table gives
an empty one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SAMPLE_ROWS = 1000  # expected rows of the sample that orders the rules

SYMBOLS = "#*$%&|<>"
BULLETS = (b"-", b"*", b"\xe2\x80\xa2")
_LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha())
_NOT_LETTERS = bytes(c for c in range(256) if c not in _LETTERS and c not in b" \t\n\v\f\r")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_in_repeats(words: Sequence[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, first one included."""
    windows = len(words) - window + 1
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if windows < 2 or len(numbers) == len(words):
        return 0
    ids = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    keys = np.zeros(windows, np.uint64)
    for k in range(window):
        keys = keys * _BASE + ids[k : k + windows]
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if not len(same):
        return 0
    one, two = order[same], order[same + 1]
    repeated = np.zeros(windows, bool)
    if all((ids[one + k] == ids[two + k]).all() for k in range(window)):
        repeated[one] = repeated[two] = True
    else:  # two different windows share a key: compare the windows themselves
        places: dict[tuple, list[int]] = {}
        for i in range(windows):
            places.setdefault(tuple(words[i : i + window]), []).append(i)
        for found in places.values():
            repeated[found] = len(found) > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + windows] |= repeated
    return int(covered.sum())


class Text:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # at ASCII white space only, as these are bytes

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, " \t\n\v\f\r"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return words_in_repeats(self.words)

    @cached_property
    def words_with_letters(self) -> int:
        return len(self.data.translate(None, _NOT_LETTERS).split())

    @cached_property
    def bullet_lines(self) -> int:
        return sum(x.lstrip().startswith(BULLETS) for x in self.lines)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]
    base: bool = False


def _few_words(t: Text) -> bool:
    return t.n_words < MIN_WORDS


def _repeats(t: Text) -> bool:
    return 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words


def _word_length(t: Text) -> bool:
    return not 3 * t.n_words <= t.word_chars <= 10 * t.n_words


def _symbols(t: Text) -> bool:
    return 10 * t.n_symbols > t.n_words


def _dup_lines(t: Text) -> bool:
    return 10 * t.n_dup_lines > 3 * len(t.lines)


def _no_letters(t: Text) -> bool:
    return 10 * t.words_with_letters < 8 * t.n_words


def _bullets(t: Text) -> bool:
    return 10 * t.bullet_lines > 9 * len(t.lines)


RULES = (
    Rule("few words", _few_words, base=True),
    Rule("repeated passages", _repeats, base=True),
    Rule("mean word length", _word_length),
    Rule("symbols", _symbols),
    Rule("repeated lines", _dup_lines),
    Rule("words without letters", _no_letters),
    Rule("bullet lines", _bullets),
)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Per rule: rows of the sample, seconds it took on them and rows it rejects."""
    rows = docs.count()

    def make():
        def step(texts):
            out = {"rule": [], "seconds": [], "rejected": [], "rows": []}
            for i, rule in enumerate(rules):
                start = time.perf_counter()
                rejected = sum(rule.rejects(Text(t)) for t in texts)
                out["rule"].append(i)
                out["seconds"].append(time.perf_counter() - start)
                out["rejected"].append(rejected)
                out["rows"].append(len(texts))
            return out

        return step

    sample = docs.select("text").sample(min(1.0, sample_rows / max(1, rows)), seed=1)
    return [
        r.asDict()
        for r in map_batches(sample, ["text"], make, "rule int, seconds double, rejected long, rows long")
        .groupBy("rule")
        .agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "rows")])
        .collect()
    ]


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost on a sample; rules that reject nothing there come last, by cost."""
    seen = {e["rule"]: e for e in estimate(docs, rules, sample_rows)}

    def key(i: int):
        if i not in seen:
            return 0.0, 0.0
        cost = max(seen[i]["seconds"], 1e-9)
        return -seen[i]["rejected"] / cost, cost

    return [rules[i] for i in sorted(range(len(rules)), key=key)]


def first_rejecting(text: Text, rules: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects; the rules after it are not evaluated."""
    return next((r.name for r in rules if r.rejects(text)), None)


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    report: Sequence[str] = MEASURES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Measures and verdict of each document: ``doc_id``, ``report``, ``base_failed``, ``kept``, ``rejected_by``.

    Reported measures are taken of every document; the others only as far as the cascade goes.
    """
    cascade, report = ordered(docs, rules, sample_rows), list(report)
    base = [r for r in rules if r.base]

    def make():
        def step(doc_ids, texts):
            out = {c: [] for c in ["doc_id", *report, "base_failed", "kept", "rejected_by"]}
            for doc_id, text in zip(doc_ids, texts):
                text = Text(text)
                by = first_rejecting(text, cascade)
                out["doc_id"].append(doc_id)
                for m in report:
                    out[m].append(getattr(text, m))
                out["base_failed"].append(by is not None and first_rejecting(text, base) is not None)
                out["kept"].append(by is None)
                out["rejected_by"].append(by)
            return out

        return step

    measures = "".join(f"{m} long, " for m in report)
    return map_batches(
        docs, ["doc_id", "text"], make,
        f"doc_id long, {measures}base_failed boolean, kept boolean, rejected_by string",
    )


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    cascade = ordered(docs, rules, sample_rows)
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([first_rejecting(Text(t), cascade) is None for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest(range(0, 8)) AS k FROM repeated) GROUP BY doc_id),
measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS with_letters,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS bullets
  FROM words LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars NOT BETWEEN 3 * n_words AND 10 * n_words
            OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR 10 * with_letters < 8 * n_words OR 10 * bullets > 9 * n_lines) AS kept
FROM judged
"""
