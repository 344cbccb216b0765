"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

Toxic and ordinary texts each have a model: how likely is a character after the ``CONTEXT`` before
it in its word. A text counts each of its words once, so that one that repeats a word a thousand times
teaches no more than another. Counts of a class lose up to ``DISCOUNT`` each, and the mass so freed goes to what is
likely after that context in all texts together, labelled or not: an interpolated Kneser-Ney model
whose shorter contexts count how many different characters precede. Both classes back off to the
same counts, so a rare expression tells the classes apart only as far as its parts do. The counts of
both classes are brought to the size of the smaller one first, so that what neither class knows is as likely
in one as in the other.

A toxic text is taken to be ordinary but for a share of its words (``SHARE``): the likelihood of a word in
it mixes both models. A text's score is the difference of its log-likelihoods as a toxic and as an ordinary
text, divided by its number of words, through a logistic curve. Labels come in five folds by a checksum of the id: the models
learn from folds 2 to 4, the curve is fitted to fold 1, fold 0 is held out.

Spark does the counting: each task turns the words it sees into counts per character sequence, all tasks'
counts meet in one table, and the probabilities are joins over that table. For scoring, the difference
of both log-probabilities is kept for each of ``2 ** SLOT_BITS`` hash slots (sequences that
share a slot have their mean, weighted by their counts), so what goes out to the tasks is 16 MB
at most, however large the corpus. No text, word or sequence is left out.

Defined results: a null, empty or wordless text scores what a difference of 0 scores. A row without id is
never labelled and not held out. Rows with the same id share its label; labels of one id that differ count as toxic;
labels other than 0 and 1 as none. Without labels of both classes in folds 1 to 4 all scores are 0. If fold 1 alone
lacks a class, folds 2 to 4 fit the curve. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, small_batches
from tidemark.session import checkpointed

CONTEXT = 4  # characters before
DISCOUNT = 0.75
SHARE = 0.02  # of the words of a toxic text that are taken to be toxic ones
FOLDS = 5
HELD_OUT, CURVE = 0, 1  # folds; the others teach the models
SLOT_BITS = 22
HELD_WORDS = 300_000  # distinct words a task counts before it passes them on
CACHED = 200_000  # words whose scores a task remembers
LONGEST = 48  # characters of a word that is remembered
BINS = 16384  # of score differences, for the curve
RANGE = 4.0  # differences beyond it count as it

EDGE = "\x02"
END = "\x03"
_WORD = re.compile(r"\w+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


class Sequences:
    """All sequences of ``CONTEXT + 1`` characters of many words, a window before each character."""

    def __init__(self, words: list[str]) -> None:
        self.text = "".join([EDGE * CONTEXT + w + END for w in words])
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.word = np.repeat(np.arange(len(words)), lengths)
        starts = np.cumsum(lengths + CONTEXT) - lengths - CONTEXT
        within = np.arange(len(self.word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.at = starts[self.word] + within
        self.key = keys(codes, self.at)


def keys(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows that start at the given places."""
    h = np.zeros(len(at), np.uint64)
    for k in range(CONTEXT + 1):
        h = (h ^ codes[at + k].astype(np.uint64)) * _MUL
        h ^= h >> np.uint64(29)
    return h * _MIX


def slots(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


_COUNTED = pa.schema([("gram", pa.string()), ("every", pa.int64()), ("toxic", pa.int64()), ("plain", pa.int64())])


def _counted(every: Counter, toxic: Counter, plain: Counter) -> pa.RecordBatch:
    words = list(every)
    seq = Sequences(words)
    _, first, group = np.unique(seq.key, return_index=True, return_inverse=True)
    grams = [seq.text[i : i + CONTEXT + 1] for i in seq.at[first].tolist()]
    columns = []
    for counts in (every, toxic, plain):
        n = np.fromiter((counts.get(w, 0) for w in words), np.int64, len(words))
        columns.append(pa.array(_added(group, n[seq.word], len(grams))))
    valid = [g.encode("utf-8", "replace").decode() for g in grams]  # lone surrogates become one character
    return pa.RecordBatch.from_arrays([pa.array(valid, pa.string()), *columns], schema=_COUNTED)


def _added(group: np.ndarray, n: np.ndarray, groups: int) -> np.ndarray:
    out = np.zeros(groups, np.int64)
    np.add.at(out, group, n)
    return out


def count(texts: DataFrame) -> DataFrame:
    """``gram, every, toxic, plain`` from ``text, toxic``: occurrences in the words of all texts and of labelled ones."""
    small_batches(texts.sparkSession)

    def run(batches):
        held = Counter(), Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                words = set(words_of(text))
                held[0].update(words)
                if toxic is not None:
                    held[1 if toxic else 2].update(words)
                if len(held[0]) > HELD_WORDS:
                    yield _counted(*held)
                    held = Counter(), Counter(), Counter()
        if held[0]:
            yield _counted(*held)

    parts = texts.select("text", "toxic").mapInArrow(run, "gram string, every long, toxic long, plain long")
    return parts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("every", "toxic", "plain")])


CONTEXT_OF = "substr(gram, 1, length(gram) - 1)"
REST_OF = "substr(gram, 2)"


def _in_context(column: Column) -> Column:
    """Over the sequences that share their context, no more than there are characters."""
    return column.over(Window.partitionBy(F.expr(CONTEXT_OF)))


def with_shared(grams: DataFrame) -> DataFrame:
    """Add ``shared``: interpolated Kneser-Ney probability of each sequence's last character in all texts.

    The longest contexts go by occurrences, shorter ones by how many characters precede them; without any
    context a character is as likely as its share of those.
    """
    levels = [grams.withColumn("n", F.col("every"))]
    for _ in range(CONTEXT):
        shorter = levels[-1].groupBy(F.expr(REST_OF).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.append(checkpointed(shorter))
    total = levels[-1].agg(F.sum("n")).first()[0]
    known = levels[-1].select("gram", (F.col("n") / F.lit(total)).alias("shared"))
    for level in reversed(levels[:-1]):
        rows = level.withColumns(
            {"__total": _in_context(F.sum("n")), "__kinds": _in_context(F.count(F.lit(1))), "__rest": F.expr(REST_OF)}
        )
        lower = known.select(F.col("gram").alias("__rest"), F.col("shared").alias("__lower"))
        freed = DISCOUNT * F.col("__kinds") * F.col("__lower")
        known = rows.join(lower, "__rest").withColumn("shared", (F.col("n") - DISCOUNT + freed) / F.col("__total"))
    return known.select(*grams.columns, "shared")


def differences(grams: DataFrame) -> DataFrame:
    """``gram, every, diff``: log-probability in toxic texts less that in ordinary ones."""
    total = grams.agg(*[F.sum(c).alias(c) for c in ("toxic", "plain")]).first()
    least = min(total.toxic, total.plain)
    rows = with_shared(grams)

    def likely(c: str) -> Column:
        n = F.col(c) * F.lit(least / total[c])
        whole, freed = (_in_context(F.sum(x)) for x in (n, F.least(n, F.lit(DISCOUNT))))
        own = (F.greatest(n - DISCOUNT, F.lit(0.0)) + freed * F.col("shared")) / whole
        return F.when(whole > 0, own).otherwise(F.col("shared"))

    return rows.select("gram", "every", (F.log(likely("toxic")) - F.log(likely("plain"))).alias("diff"))


def score_table(diffs: DataFrame) -> np.ndarray:
    """Score difference of every hash slot; at most ``2 ** SLOT_BITS`` rows come to the driver."""

    def start():
        def step(grams, every, diff):
            codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
            key = keys(codes, np.arange(len(grams)) * (CONTEXT + 1))
            return {"slot": slots(key), "weight": every, "part": [n * d for n, d in zip(every, diff)]}

        return step

    hashed = map_batches(diffs, ["gram", "every", "diff"], start, "slot int, weight long, part double")
    # a sum in a fixed order, so that a task that runs again adds up the same
    rows = (
        hashed.groupBy("slot")
        .agg(F.sum("weight").alias("w"), F.array_sort(F.collect_list("part")).alias("parts"))
        .select("slot", (F.aggregate("parts", F.lit(0.0), lambda a, x: a + x) / F.col("w")).alias("diff"))
        .toArrow()
    )
    table = np.zeros(1 << SLOT_BITS, np.float32)
    table[rows["slot"].to_numpy()] = rows["diff"].to_numpy()
    return table


class Scorer:
    """Differences of log-likelihoods of texts, word by word."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        self.known: dict[str, float] = {}

    def of(self, words: list[str]) -> list[float]:
        seq = Sequences(words)
        ratio = np.bincount(seq.word, self.table[slots(seq.key)], minlength=len(words))
        return np.log1p(SHARE * np.expm1(np.minimum(ratio, 500))).tolist()

    def __call__(self, texts: list[list[str]]) -> list[float | None]:
        """Mean difference of each text's words; None without words."""
        missing = list(set().union(*texts).difference(self.known))
        if len(self.known) + len(missing) > CACHED:
            self.known = {}
            missing = list(set().union(*texts))
        found = dict(zip(missing, self.of(missing))) if missing else {}
        short = {w: v for w, v in found.items() if len(w) <= LONGEST}
        self.known.update(short)
        get = (self.known if len(short) == len(found) else {**self.known, **found}).__getitem__
        return [sum(map(get, w)) / len(w) if w else None for w in texts]


def likelihoods(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``doc_id, diff``: difference of log-likelihoods per word."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def start():
        score = Scorer(shared.value)

        def step(ids, texts):
            return {"doc_id": ids, "diff": score([words_of(t) for t in texts])}

        return step

    return map_batches(docs, ["doc_id", "text"], start, "doc_id long, diff double")


def one_label(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of labelled rows outside the held-out fold, one row per id."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    return usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def with_labels(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """Documents with their label where they have one. Rows without id, which have none, are dealt out."""
    none = F.pmod(F.hash("doc_id"), F.lit(1))  # 0, computed so that it stays a join key
    dealt = F.when(F.col("doc_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int"))
    left = docs.select("doc_id", *columns, F.coalesce(dealt, none).alias("__part"))
    right = labels.select("doc_id", "toxic", none.alias("__part")).hint("shuffle_hash")
    return left.join(right, ["doc_id", "__part"], "left").drop("__part")


def fit_curve(bins: list[tuple[int, int, int]], steps: int = 100) -> tuple[float, float, float] | None:
    """Scale, offset and slope of a logistic curve over (bin, label, rows), both classes weighing the same.

    The curve goes over the inverse hyperbolic sine of the difference, in units of its spread among ordinary
    texts, so that texts full of insults do not set the slope for all. Newton steps with a small
    penalty on the slope; None where a class is missing.
    """
    x, y, n = (np.array(v, float) for v in zip(*bins)) if bins else (np.zeros(0),) * 3
    x = (x + 0.5) / BINS * 2 * RANGE - RANGE
    ones, zeros = n[y == 1].sum(), n[y == 0].sum()
    if not ones or not zeros:
        return None
    plain = x[y == 0], n[y == 0]
    mean = np.average(plain[0], weights=plain[1])
    scale = max(np.sqrt(np.average((plain[0] - mean) ** 2, weights=plain[1])), 2 * RANGE / BINS)
    weight = n / np.where(y == 1, ones, zeros)
    features = np.stack([np.ones_like(x), np.arcsinh(x / scale)], axis=1)
    beta, penalty = np.zeros(2), np.diag([0.0, 1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -500, 500)))
        gradient = features.T @ (weight * (p - y)) + penalty @ beta
        hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + penalty + 1e-12 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 2.0 / (np.abs(move).max() or 1.0))
        beta -= move
        if np.abs(move).max() < 1e-9:
            break
    return float(scale), float(beta[0]), float(max(beta[1], 0.0))


def _bins(scored: DataFrame, folds: list[int]) -> list[tuple[int, int, int]]:
    """Labelled rows per bin of their difference, ``2 * BINS`` counts at most."""
    at = F.floor((F.coalesce("diff", F.lit(0.0)) + RANGE) / (2 * RANGE) * BINS)
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), at)).cast("int")
    rows = scored.where(F.col("toxic").isNotNull() & fold(F.col("doc_id")).isin(folds))
    return [tuple(r) for r in rows.groupBy(at.alias("bin"), "toxic").count().orderBy("bin", "toxic").collect()]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    docs = docs.select("doc_id", "text")
    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    known = one_label(labels)
    # only texts that may teach meet the labels; the others are counted where they are read
    teaches = F.coalesce(~fold(F.col("doc_id")).isin(HELD_OUT, CURVE), F.lit(False))
    taught = with_labels(docs.where(teaches), known, ["text"]).select("text", "toxic")
    others = docs.where(~teaches).select("text", F.lit(None).cast("int").alias("toxic"))
    grams = checkpointed(count(taught.unionByName(others)))
    total = grams.agg(F.sum("toxic"), F.sum("plain")).first()
    if not total[0] or not total[1]:
        return docs.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    scored = checkpointed(likelihoods(docs, score_table(differences(grams))))
    labelled = with_labels(scored, known, ["diff"])
    teachers = [f for f in range(FOLDS) if f not in (HELD_OUT, CURVE)]
    curve = fit_curve(_bins(labelled, [CURVE])) or fit_curve(_bins(labelled, teachers))
    scale, offset, slope = curve
    difference = F.asinh(F.coalesce("diff", F.lit(0.0)) / F.lit(scale))
    value = 1 / (1 + F.exp(-(F.lit(offset) + F.lit(slope) * difference)))
    return scored.select("doc_id", held, value.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
