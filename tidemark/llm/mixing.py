"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. Each dimension has target shares for some
named values; all other values of it form one more, with what is left. Where the named shares leave
nothing, the others have their natural share and the named ones divide the rest, so no value is
dropped for not being named; only a target of zero given for a value drops it. The cells' token counts are
raked to the targets one dimension after the other until all margins fit, with no cell beyond the
tokens it has; the result is a sampling probability per cell, and each document is drawn by its
cell's probability.

Whether a document is drawn follows from a hash of its id (of its text where the id is null), so a
rerun draws the same ones and rows that repeat an id share their fate. Null sources and languages
count as values not named. Null and empty texts have no tokens and follow their cell like any other. Named values without tokens
leave their share to the others. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
BUDGET = 0.8  # share of all tokens to draw
ROUNDS = 500
TOLERANCE = 1e-10
LEAST_LEFT = 1e-9  # less than this is a rounding of nothing

#: Production targets as shares of tokens; what a dimension leaves open goes to its other values. The
#: languages leave nothing open, so null and other languages keep their natural share. Only src0 is
#: weighted against the other sources, which share the rest as they come.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.30},
    "lang": {"en": 0.56, "de": 0.16, "fr": 0.15, "es": 0.13},
    "topic": {"short": 0.02, "medium": 0.45, "notice": 0.05},
}


def tokens() -> Column:
    """Words of the text: runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


NOTICE = r"(?i)licensed under|all rights reserved|license\."
_TOKENS, _TOPIC, _CHANCE = "__mixing_tokens", "__mixing_topic", "__mixing_chance"


def _measured(docs: DataFrame) -> DataFrame:
    """Add tokens and a coarse topic: notices of rights and licences, else the register by length.

    The steps stand apart so that each text is scanned once for either.
    """
    n = F.col(_TOKENS)
    register = F.when(n < 100, "short").when(n < 1000, "medium").otherwise(OTHER)
    notice = F.coalesce(F.col("text").rlike(NOTICE), F.lit(False))
    return docs.withColumns({_TOKENS: tokens(), _TOPIC: notice}).withColumn(
        _TOPIC, F.when(F.col(_TOPIC), "notice").otherwise(register)
    )


class Cells(NamedTuple):
    """Sampling probability per cell, and the margins that the draw is expected to have."""

    names: list[tuple[str, ...]]
    tokens: np.ndarray
    probability: np.ndarray

    def margin(self, dimension: int) -> dict[str, float]:
        drawn = self.tokens * self.probability
        out: dict[str, float] = {}
        for cell, n in zip(self.names, drawn):
            out[cell[dimension]] = out.get(cell[dimension], 0.0) + n / max(drawn.sum(), 1e-300)
        return out


def rake(
    counts: Mapping[tuple[str, ...], float],
    targets: Mapping[str, Mapping[str, float]],
    budget: float = BUDGET,
    rounds: int = ROUNDS,
) -> Cells:
    """Probabilities whose expected tokens meet each dimension's targets, none above one.

    A value that its cells cannot fill even when drawn whole gives them all; the others then keep
    their targets in proportion.
    """
    names = sorted(counts)
    n = np.array([counts[c] for c in names], float)
    p = np.full(len(names), min(1.0, budget))
    total = budget * n.sum()
    if not total:
        return Cells(names, n, p)
    margins = []
    for d, named in enumerate(targets.values()):
        values = sorted({c[d] for c in names})
        shares = {v: named.get(v, 0.0) for v in values}
        there = {v: n[[c[d] == v for c in names]].sum() for v in values}
        if OTHER in shares and OTHER not in named:
            left = 1 - sum(named.values())
            if left < LEAST_LEFT:
                left = there[OTHER] / n.sum()
                here = sum(shares.values()) or 1.0
                shares = {v: s * (1 - left) / here for v, s in shares.items()}
            shares[OTHER] = left
        whole = sum(s for v, s in shares.items() if there[v])
        for v in values:
            at = np.array([c[d] == v for c in names])
            if there[v] and whole:
                margins.append((at, total * shares[v] / whole))
    for _ in range(rounds):
        before = p.copy()
        for at, wanted in margins:
            expected = (n * p)[at].sum()
            if expected:
                p[at] = np.minimum(1.0, p[at] * wanted / expected)
        if np.abs(p - before).max() < TOLERANCE:
            break
    return Cells(names, n, p)


def _drawn(seed: int) -> Column:
    """A number in [0, 1) from the document's id, 53 bits of a hash."""
    by_id, by_text = (F.xxhash64(F.lit(seed), c) for c in ("doc_id", "text"))
    bits = F.shiftrightunsigned(F.when(F.col("doc_id").isNull(), by_text).otherwise(by_id), 11)
    return bits / F.lit(float(1 << 53))


def _with_chance(docs: DataFrame, targets: Mapping[str, Mapping[str, float]], budget: float) -> DataFrame:
    """Add tokens, topic and sampling probability to documents.

    The number of cells is bounded by the targets, not by the data: named values and one more per
    dimension; their counts are what the driver gets.
    """
    measured = _measured(docs)
    value = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col(_TOPIC)}
    cell = [F.when(value[d].isin(list(v)), value[d]).otherwise(OTHER) for d, v in targets.items()]
    counted = (
        measured.select(*[c.alias(d) for c, d in zip(cell, targets)], F.col(_TOKENS).alias("n"))
        .groupBy(*targets)
        .agg(F.sum("n").alias("n"))
    )
    cells = rake({tuple(r[d] for d in targets): r["n"] for r in counted.collect()}, targets, budget)
    if not cells.names:
        return measured.withColumn(_CHANCE, F.lit(min(1.0, budget)))
    known = [F.lit(x) for c, p in zip(cells.names, cells.probability) for x in ("\t".join(c), float(p))]
    return measured.withColumn(_CHANCE, F.element_at(F.create_map(*known), F.concat_ws("\t", *cell)))


def weighted(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] = TARGETS,
    budget: float = BUDGET,
    seed: int = 7,
) -> DataFrame:
    """Each document's topic, tokens, weight against its natural share, probability and draw."""
    chance = F.col(_CHANCE)
    return _with_chance(docs, targets, budget).select(
        "doc_id",
        "source",
        "lang",
        F.col(_TOPIC).alias("topic"),
        F.col(_TOKENS).alias("n_tokens"),
        (chance / budget).alias("weight"),
        chance.alias("probability"),
        (_drawn(seed) < chance).alias("sampled"),
    )


def keep(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] = TARGETS,
    budget: float = BUDGET,
    seed: int = 7,
) -> DataFrame:
    """The drawn documents, with all their columns."""
    return _with_chance(docs, targets, budget).where(_drawn(seed) < F.col(_CHANCE)).select(*docs.columns)
