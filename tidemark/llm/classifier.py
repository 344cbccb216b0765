"""Quality classifier from weak labels.

Heuristic labellers each vote good, bad or nothing on a text. Expectation-maximisation over the
counts of all vote patterns of the corpus estimates, for each labeller, how often it votes what on
good and on bad texts, and so the probability that a text with given votes is good. These posterior
labels train a linear scorer on hashed features of a sample of at most about ``TRAIN_ROWS`` rows; the
scorer then judges every whole text.

Null and empty texts score like a text without words. Null ids and repeated rows are scored like any
other row; a corpus of no rows, or one in which no labeller finds a bad text, gets a scorer that
keeps everything it has no evidence against. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches, small_batches
from tidemark.llm.quality_rules import Text
from tidemark.session import checkpointed

TRAIN_ROWS = 10_000  # bound on the rows that fit the scorer, met in expectation
BUCKETS = 1 << 16
ROUNDS = 100
REGULARISATION = 1e-4
ITERATIONS = 40
THRESHOLD = 0.5

BAD, NONE, GOOD = "b", "-", "g"

# fixed values: frequent function words of the corpus languages
FUNCTION_WORDS = frozenset(
    w.encode()
    for w in (
        "the of and to in a is that for it with as was on by "
        "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
        "le la les de des et en un une du que est pour qui dans "
        "el los las y del se por con una para al lo como"
    ).split()
)


class Page(Text):
    """A text with the further measures that labellers look at, taken once."""

    @property
    def letters_upper(self) -> tuple[int, int]:
        data = self.data
        upper = len(data) - len(data.translate(None, _UPPER))
        return len(data) - len(data.translate(None, _LETTERS)), upper


_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_ASCII = bytes(range(128))
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _vote(bad: bool, looked: bool = True) -> str:
    """Bad, or else good if there was enough text to look at."""
    return NONE if not looked else BAD if bad else GOOD


def by_symbols(p: Page) -> str:
    return _vote(10 * p.n_symbols > p.n_words)


def by_repeated_lines(p: Page) -> str:
    return _vote(10 * p.n_dup_lines > 2 * len(p.lines), len(p.lines) > 2)


def by_repeated_words(p: Page) -> str:
    return _vote(10 * p.n_repeat_words > 2 * p.n_words, p.n_words >= 50)


def by_case(p: Page) -> str:
    letters, upper = p.letters_upper
    return _vote(10 * upper > 3 * letters, letters > 50)


def by_marks(p: Page) -> str:
    return _vote(20 * p.data.count(b"!!") > p.n_words)


def by_numbers(p: Page) -> str:
    return _vote(10 * p.words_with_letters < 7 * p.n_words, p.n_words >= 20)


def by_sentences(p: Page) -> str:
    ended = sum(x.rstrip().endswith((b".", b"!", b"?", b":", b'"')) for x in p.lines)
    return _vote(10 * ended < len(p.lines), p.n_words >= 50)


def by_function_words(p: Page) -> str:
    """No vote on a text in another script, or without any of the words: its language may not be among these."""
    words = p.data.translate(_PLAIN).split()
    known = sum(map(FUNCTION_WORDS.__contains__, words))
    latin = p.letters_upper[0] > len(p.data.translate(None, _ASCII))
    return _vote(50 * known < len(words), p.n_words >= 50 and known > 0 and latin)


LABELLERS: tuple[Callable[[Page], str], ...] = (
    by_symbols,
    by_repeated_lines,
    by_repeated_words,
    by_case,
    by_marks,
    by_numbers,
    by_sentences,
    by_function_words,
)


def votes_of(page: Page, labellers: Sequence = LABELLERS) -> str:
    return "".join(f(page) for f in labellers)


class Accuracies(NamedTuple):
    """Share of good texts, and how often each labeller's votes are bad on bad and on good texts."""

    good: float
    fires: np.ndarray  # labeller, class (bad, good)

    def posterior(self, pattern: str) -> float:
        """Probability that a text with these votes is good; no vote is no evidence."""
        odds = np.log(1 - self.good) - np.log(self.good)
        for vote, (on_bad, on_good) in zip(pattern, self.fires):
            if vote == BAD:
                odds += np.log(on_bad / on_good)
            elif vote == GOOD:
                odds += np.log((1 - on_bad) / (1 - on_good))
        return float(1 / (1 + np.exp(np.clip(odds, -500, 500))))


#: Where the iteration starts, and what it weighs as pseudo-votes: bad texts are bad in one way or
#: another, so a labeller fires on some of them, and hardly ever on a good text.
FIRES = (0.25, 0.002)
GOOD_SHARE = 0.9
PRIOR_SHARE = 0.01  # weight of these as a share of the texts
LEAST_FIRES = 1e-4
#: A labeller that fires alone on some texts may be wrong on good ones or right on a kind of junk of its
#: own; counts cannot tell. Texts of symbols are junk by definition: it is held to this share of good texts.
HELD = (by_symbols,)
MOST_FALSE = 0.002


def estimate(patterns: Mapping[str, int], rounds: int = ROUNDS, held: Sequence[int] = ()) -> Accuracies:
    """Accuracies by expectation-maximisation over the counts of vote patterns.

    Both rates of a labeller are estimated; it fires on bad texts at least as often as on good ones.
    Those at the places ``held`` fire on no more than ``MOST_FALSE`` of the good ones.
    """
    labellers = len(next(iter(patterns), ""))
    now = Accuracies(GOOD_SHARE, np.tile(FIRES, (labellers, 1)))
    if not patterns:
        return now
    weights = np.array(list(patterns.values()), float)
    fired = np.array([[v == BAD for v in p] for p in patterns], float)
    voted = np.array([[v != NONE for v in p] for p in patterns], float)
    strength = PRIOR_SHARE * weights.sum() + 1
    for _ in range(rounds):
        good = np.array([now.posterior(p) for p in patterns])
        by_class = np.stack([weights * (1 - good), weights * good], axis=1)
        fires = (fired.T @ by_class + strength * np.array(FIRES)) / (voted.T @ by_class + strength)
        fires = np.clip(fires, LEAST_FIRES, 0.99)
        fires[list(held), 1] = np.minimum(fires[list(held), 1], MOST_FALSE)
        fires[:, 0] = np.maximum(fires[:, 0], fires[:, 1])
        share = (by_class[:, 1].sum() + GOOD_SHARE * strength) / (weights.sum() + strength)
        moved = abs(share - now.good) + np.abs(fires - now.fires).max()
        now = Accuracies(float(np.clip(share, 0.05, 0.99)), fires)
        if moved < 1e-9:
            break
    return now


def _shapes() -> bytes:
    kinds = bytearray(range(256))
    for c in range(256):
        kinds[c] = ord("A") if 65 <= c <= 90 else ord("a") if c >= 128 or 97 <= c <= 122 else ord("0") if 48 <= c <= 57 else c
    return bytes(kinds)


_SHAPE = _shapes()


REMEMBERED = 200_000  # words whose buckets a task keeps


class _Shapes(dict):
    """Buckets of word shapes: letter cases, digits and marks, runs drawn together."""

    def __missing__(self, shape: bytes) -> int:
        drawn = bytes(c for i, c in enumerate(shape) if not i or c != shape[i - 1])
        found = zlib.crc32(b"s" + drawn) % BUCKETS
        if len(shape) <= 32 and len(self) < REMEMBERED:
            self[shape] = found
        return found


class _Hashed(dict):
    """Buckets of a word and of its shape, as one number: the shape's times ``BUCKETS`` more."""

    def __init__(self) -> None:
        super().__init__()
        self.shapes = _Shapes()

    def __missing__(self, word: bytes) -> int:
        found = zlib.crc32(b"w" + word.lower()) % BUCKETS + BUCKETS * self.shapes[word.translate(_SHAPE)]
        if len(word) <= 32:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


def features(page: Page, hashed: _Hashed) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in ascending order and their values: words and shapes by share, measures by level."""
    counts = Counter(page.words)
    both = np.fromiter(map(hashed.__getitem__, counts), np.int64, len(counts))
    shares = np.fromiter(counts.values(), float, len(counts)) / max(1, page.n_words)
    letters, upper = page.letters_upper
    levels = {
        "symbols": page.n_symbols / max(1, page.n_words),
        "lines": page.n_dup_lines / max(1, len(page.lines)),
        "words": page.n_repeat_words / max(1, page.n_words),
        "upper": upper / max(1, letters),
        "marks": 4 * page.data.count(b"!!") / max(1, page.n_words),
    }
    keys = [f"m{name}{min(9, int(10 * level))}" for name, level in levels.items() if level > 0]
    marked = np.array([zlib.crc32(k.encode()) % BUCKETS for k in keys], np.int64)
    buckets, where = np.unique(np.concatenate([both % BUCKETS, both // BUCKETS, marked]), return_inverse=True)
    values = np.bincount(where, np.concatenate([shares, shares, np.ones(len(marked))]), len(buckets))
    return buckets, np.sqrt(values)


class Scorer(NamedTuple):
    weights: np.ndarray
    intercept: float

    def score(self, page: Page, hashed: _Hashed) -> float:
        buckets, values = features(page, hashed)
        margin = self.intercept + float(self.weights[buckets] @ values)
        return round(1 / (1 + np.exp(-np.clip(margin, -500, 500))), 6)


class Model(NamedTuple):
    accuracies: Accuracies
    scorer: Scorer


def vote_counts(docs: DataFrame, labellers: Sequence = LABELLERS) -> dict[str, int]:
    """Number of documents per vote pattern, over the whole corpus; at most 3 to the labellers rows."""

    def make():
        def step(texts):
            counts = Counter(votes_of(Page(t), labellers) for t in texts)
            return {"votes": list(counts), "n": list(counts.values())}

        return step

    counted = map_batches(docs, ["text"], make, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    return {r["votes"]: r["n"] for r in counted.collect()}


def train(docs: DataFrame, labellers: Sequence = LABELLERS, train_rows: int = TRAIN_ROWS) -> Model:
    """Accuracies from all documents, and a scorer from a sample labelled by their posteriors."""
    counts = vote_counts(docs, labellers)
    accuracies = estimate(counts, held=[k for k, f in enumerate(labellers) if f in HELD])
    known = {p: accuracies.posterior(p) for p in counts}
    rows = sum(counts.values())
    if not rows:
        return Model(accuracies, Scorer(np.zeros(BUCKETS), 1.0))
    small_batches(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("label", T.DoubleType()),
            T.StructField("weight", T.DoubleType()),
            T.StructField("features", VectorUDT()),
        ]
    )
    vector = pa.struct(
        [("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]
    )

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed()
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text in batch.column(0).to_pylist():
                page = Page(text)
                good = known[votes_of(page, labellers)]
                buckets, values = features(page, hashed)
                row = {"type": 0, "size": BUCKETS, "indices": buckets.tolist(), "values": values.tolist()}
                # a text of two minds is two examples
                for label, weight in ((1.0, good), (0.0, 1 - good)):
                    if weight > 1e-6:
                        for held, value in zip(out, (label, weight, row)):
                            held.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.float64()), pa.array(out[1], pa.float64()), pa.array(out[2], vector)],
                names=["label", "weight", "features"],
            )

    # the examples are stored first: they come from tasks over the whole corpus, the fit reads a few of them
    sample = docs.select("text").sample(min(1.0, train_rows / rows), seed=2)
    stored = checkpointed(sample.mapInArrow(examples, schema))
    fit = LogisticRegression(
        weightCol="weight", regParam=REGULARISATION, maxIter=ITERATIONS, standardization=False
    ).fit(stored.coalesce(8))
    return Model(accuracies, Scorer(fit.coefficients.toArray(), float(fit.intercept)))


def score(docs: DataFrame, model: Model | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` (probability of good quality) and ``kept`` of every document."""
    scorer = (model or train(docs)).scorer

    def make():
        hashed = _Hashed()

        def step(doc_ids, texts):
            scores = [scorer.score(Page(t), hashed) for t in texts]
            return {"doc_id": doc_ids, "score": scores, "kept": [s >= threshold for s in scores]}

        return step

    return map_batches(docs, ["doc_id", "text"], make, "doc_id long, score double, kept boolean")


def keep(docs: DataFrame, model: Model | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    scorer = (model or train(docs)).scorer
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _Hashed()
        for batch in batches:
            kept = [scorer.score(Page(t), hashed) >= threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
