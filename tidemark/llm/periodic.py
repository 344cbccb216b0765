"""Periodic runs of words, by Kruskal over the longest common prefixes of suffixes.

A run is a stretch of consecutive words with smallest period q, at least ``max(12, 2 * q)`` words
long, that neither neighbouring word extends. Suffixes of the text are put in order, and neighbours
in that order are united by decreasing longest common prefix (LCP), the smaller class into the larger;
each class keeps its positions in order. When two classes meet at LCP l, every two positions that become
neighbours at a distance q of at most l start a stretch ``[i, j + l)`` with period q. In between
lies no position with the same l words, so q is the smallest period, and the stretch ends where its
run ends. The first word of a run is among the positions found, so of all stretches with the same
end and period the one that starts first is the run.

Runs of at least 12 words need an LCP of at least 6. Only positions whose next six words stand a second
time in the text take part; the others could never join a class at such an LCP. Texts without any
are done after one sort of six-word hashes.

Defined results: a null or empty text has no words and no runs; rows are judged one by one, so
repeated rows and ids, a null id (whose text is taken as it stands) and other columns change nothing; an
empty table gives no rows. Texts of any length are processed whole.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_batches

LEAST = 12  # words in a run
LEAST_LCP = 6  # of the first word of a run and the word one period on: length - q >= max(12 - q, q)
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
_MIX = [np.uint64(m) for m in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
)]

Run = tuple[int, int, int]  # start, length, period


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks, tabs and line ends; other white space belongs to words."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def with_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by checksum repeats some of its words, as the query's contract says."""
    h, n = (1, 0) if doc_id is None else (zlib.crc32(str(doc_id).encode()), len(words))
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


def _repeated(ids: np.ndarray) -> np.ndarray:
    """Positions whose six words stand at least twice, by hash; a false one does no harm."""
    m = len(ids) - LEAST_LCP + 1
    if m < 2:
        return np.empty(0, np.int64)
    ids = ids.astype(np.uint64)
    h = ids[:m] * _MIX[0]
    for k in range(1, LEAST_LCP):
        h += ids[k : k + m] * _MIX[k]
    in_order = np.sort(h)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    return np.empty(0, np.int64) if not len(twice) else np.flatnonzero(np.isin(h, twice))


def _ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4 ... words, until every rank is its own.

    A rank is the number of suffixes that are smaller, so splitting a group leaves all others alone.
    Past the end stands -1.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    active, group = order, ids[order]
    rank = np.full(n + 1, -1, np.int64)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))
    levels, step = [rank], 1
    while True:
        old = rank[active]
        sizes = np.bincount(old, minlength=1)
        active = active[sizes[old] > 1]  # in order of rank, as before
        if not len(active):
            return levels
        old, then = rank[active], rank[np.minimum(active + step, n)]
        order = np.lexsort((then, old))
        active, old, then = active[order], old[order], then[order]
        new_old = np.r_[True, old[1:] != old[:-1]]
        new = new_old | np.r_[True, then[1:] != then[:-1]]
        at = np.arange(len(active))
        in_group = at - np.maximum.accumulate(np.where(new_old, at, 0))
        rank = rank.copy()
        rank[active] = old + np.maximum.accumulate(np.where(new, at, 0)) - (at - in_group)
        levels.append(rank)
        step *= 2


def neighbours_by_lcp(ids: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that are neighbours in the order of suffixes, with their LCP, by decreasing LCP."""
    levels = _ranks(ids)
    n = len(ids)
    order = positions[np.argsort(levels[-1][positions])]
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = levels[k][np.minimum(a + lcp, n)], levels[k][np.minimum(b + lcp, n)]
        lcp += np.where((x == y) & (x >= 0), 1 << k, 0)
    keep = np.flatnonzero(lcp >= LEAST_LCP)
    keep = keep[np.argsort(-lcp[keep], kind="stable")]
    return a[keep], b[keep], lcp[keep]


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs by start, then period."""
    n = len(words)
    if n < LEAST:
        return []
    number = dict(zip(words, range(n)))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    positions = _repeated(ids)
    if not len(positions):
        return []
    return _kruskal(*neighbours_by_lcp(ids, positions))


def _kruskal(lefts: np.ndarray, rights: np.ndarray, lcps: np.ndarray) -> list[Run]:
    """Unite classes of positions by decreasing LCP; new neighbours within the LCP start stretches."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    first: dict[tuple[int, int], int] = {}  # (end, period) -> smallest start

    def seed(i: int, j: int, lcp: int) -> None:
        q = j - i
        if q <= lcp:
            key = (j + lcp, q)
            if first.get(key, i) >= i:
                first[key] = i

    for a, b, lcp in zip(lefts.tolist(), rights.tolist(), lcps.tolist()):
        a, b = find(a), find(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        members[a] = large
        if small[0] > large[-1]:
            seed(large[-1], small[0], lcp)
            large += small
            continue
        if len(small) * 16 > len(large):
            large += small
            large.sort()  # two ordered stretches: one merge
        else:
            for p in small:
                insort(large, p)
        at, last = 0, len(large) - 1
        for before, p, after in zip([-1, *small], small, [*small[1:], -1]):
            at = bisect_left(large, p, at)
            if at and large[at - 1] != before:  # positions of one class were neighbours before
                seed(large[at - 1], p, lcp)
            if at < last and large[at + 1] != after:
                seed(p, large[at + 1], lcp)
    found = [(i, end - i, q) for (end, q), i in first.items() if end - i >= LEAST]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without what repeats the first period of a run."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _digest(doc_id: int | None, text: str | None, reshape) -> tuple:
    words = reshape(doc_id, words_of(text)) if reshape else words_of(text)
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
    )


def detect(docs: DataFrame) -> DataFrame:
    """The documents with ``runs``, an array of (start, length, period), and ``collapsed``, the shortened text."""

    def start():
        def step(ids, texts):
            split = [words_of(t) for t in texts]
            runs = [runs_of(w) for w in split]
            texts = [b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(split, runs)]
            return {
                "doc_id": ids,
                "runs": [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs],
                "collapsed": texts,
            }

        return step

    schema = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_batches(docs, ["doc_id", "text"], start, schema)


def digest(docs: DataFrame, reshape=with_period) -> DataFrame:
    """Number of runs, the longest one, and checksums of all runs and of the shortened text.

    ``reshape(doc_id, words)`` changes the words first; None leaves them as they are.
    """
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def start():
        def step(ids, texts):
            return dict(zip(names, map(list, zip(*[_digest(i, t, reshape) for i, t in zip(ids, texts)]))))

        return step

    return map_batches(docs, ["doc_id", "text"], start, SCHEMA)
