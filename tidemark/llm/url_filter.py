"""URL filters: rules first, then trust and distrust that spread over links between hosts.

The rule that fits an url best judges it. For the other urls every host gets two scores: trust is
personalised PageRank along links from hosts whose urls the rules allow, distrust the same against
links from hosts whose urls they block, both with a seed weight equal to the share of the host's urls
so judged. What reaches a host is split over all links, so it is taken as a share of what would have
reached it had every host that rules judge been blocked (or allowed) whole: the share does not depend on
how many hosts link to the same one. A host's own judged urls count by their share, and what reaches it
stands for the others. Its urls without a rule are blocked where distrust exceeds trust by ``MARGIN``.

Scores count walks along as many links as it takes until damping has left ``TOLERANCE`` of what set out
(57 links); hosts further from every judged one are reached by nothing. So the number of rounds is
bounded, whatever the graph, and does not grow with its longest path.

A null url, or one without ``://``, has an empty host and path, fits no rule, links to nothing and is
allowed. Null ids and repeated rows are judged like any
other row; a null html has no links; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.session import checkpointed

# fixed values: the rules that the query applies
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
TOLERANCE = 1e-4  # of a score
MARGIN = 0.5  # of shares, from -1 to 1
LEAST = 1e-290  # what reaches a host in parts smaller than this has no exact share
SALTS = 16  # parts of every host's links, while they are weighted
LINKS_PER_PART = 50_000  # links of one host that meet its scores in one task
HEAVY = 1_000  # a host with more than this share of the open urls is heavy: fewer hosts than this are

_URL = re.compile(r"://([^/?#]*)([^?#]*)")
_LINK = re.compile(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)""")
_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host, lower-cased in A-Z, and path."""
    found = _URL.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class RuleSet:
    """Rules by host, to be looked up by a host's suffixes."""

    def __init__(self, rules: Sequence[tuple[str, str]]) -> None:
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def best(self, host: str, path: str) -> tuple[str, str] | None:
        """Longest rule that fits, and its verdict; among equally long ones the longer host wins, then block."""
        found = []
        while host:
            found += [
                (len(rule), len(host), verdict == "block", rule, verdict)
                for prefix, rule, verdict in self.by_host.get(host, ())
                if path.startswith(prefix)
            ]
            host = host.partition(".")[2]
        return max(found)[3:] if found else None


def links_of(html: str | None, host: str) -> list[str]:
    """Other hosts that a page links to."""
    return sorted({h.translate(_LOWER) for h in _LINK.findall(html or "")} - {host})


def match_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` (null where no rule fits) and the hosts linked to."""

    def make():
        known = RuleSet(rules)

        def step(page_ids, urls, htmls):
            out = {c: [] for c in ("page_id", "host", "path", "rule", "verdict", "links")}
            for page_id, url, html in zip(page_ids, urls, htmls):
                host, path = split_url(url)
                rule, verdict = known.best(host, path) or (None, None)
                for c, v in zip(out, (page_id, host, path, rule, verdict, links_of(html, host))):
                    out[c].append(v)
            return out

        return step

    return map_batches(
        pages, ["page_id", "url", "html"], make,
        "page_id long, host string, path string, rule string, verdict string, links array<string>",
    )


def _share(verdict: str) -> Column:
    return F.count_if(F.col("verdict") == verdict) / F.count(F.lit(1))


def _moves(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every link in both directions, with the share of a score that moves along it, and the hosts.

    ``(host, part, to, forth, back)`` and ``(host, parts)``: trust moves along ``forth``, distrust along
    ``back``. The links of a host with many are dealt out to ``parts``.
    """
    none = F.lit(0.0)
    ends = edges.select(
        F.col("source").alias("host"), F.col("target").alias("to"), F.col("weight").alias("forth"), none.alias("back")
    ).union(edges.select(F.col("target"), F.col("source"), none, F.col("weight")))
    totals = ends.groupBy("host").agg(
        F.sum("forth").alias("out"), F.sum("back").alias("into"),
        (F.floor(F.count(F.lit(1)) / LINKS_PER_PART) + 1).cast("int").alias("parts"),
    )
    place = F.xxhash64("to")
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    moves = (
        ends.withColumn("salt", F.pmod(place, F.lit(SALTS)).cast("int"))
        .join(salted, ["host", "salt"])
        .select(
            "host", F.pmod(place, F.col("parts")).cast("int").alias("part"), "to",
            F.when(F.col("forth") > 0, F.col("forth") / F.col("out")).otherwise(none).alias("forth"),
            F.when(F.col("back") > 0, F.col("back") / F.col("into")).otherwise(none).alias("back"),
        )
    )
    return checkpointed(moves), totals.select("host", "parts")


def _received(
    edges: DataFrame,
    seeds: DataFrame,
    forth: Sequence[str],
    back: Sequence[str],
    damping: float = DAMPING,
    rounds: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """What reaches every host over links, its own seeds left out: ``(host, <scores>)``.

    All scores are carried in one pass per round. Ends after ``rounds``, by default as many as leave
    ``tolerance`` of a seed, or when no score moves by more than ``tolerance`` of itself.
    """
    if rounds is None:
        rounds = ceil(log(tolerance) / log(damping))
    names = [*forth, *back]
    moves, hosts = _moves(edges)
    none = F.lit(0.0)
    blank = [none.alias(f"was_{c}") for c in names]
    # hosts and their seeds, added up and not joined: the planner's guess of a join's size is a product
    seeds = checkpointed(
        seeds.select("host", F.lit(1).alias("parts"), *names)
        .union(hosts.select("host", "parts", *[none for _ in names]))
        .groupBy("host")
        .agg(F.max("parts").alias("parts"), *[F.sum(c).alias(c) for c in names])
    )
    sent, got = seeds, seeds.select("host", *[none.alias(c) for c in names])
    for _ in range(rounds):
        sending = sent.where(F.greatest(*names) > 0) if len(names) > 1 else sent.where(F.col(names[0]) > 0)
        along = {c: "forth" if c in forth else "back" for c in names}
        arriving = (
            sending.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .join(moves, ["host", "part"])
            .select(F.col("to").alias("host"), *[(damping * F.col(c) * F.col(w)).alias(c) for c, w in along.items()], *blank)
        )
        before = got.select("host", *[none.alias(c) for c in names], *[F.col(c).alias(f"was_{c}") for c in names])
        start = seeds.select("host", "parts", *[F.col(c).alias(f"seed_{c}") for c in names])
        moved = checkpointed(
            arriving.union(before)
            .groupBy("host")
            .agg(*[F.sum(c).alias(c) for c in [*names, *[f"was_{c}" for c in names]]])
        )
        got = moved.select("host", *names)
        still = [F.abs(F.col(c) - F.col(f"was_{c}")) > tolerance * F.col(c) for c in names]
        if moved.where(reduce(Column.__or__, still)).isEmpty():
            break
        sent = start.join(got, "host").select(
            "host", "parts", *[(F.col(f"seed_{c}") + F.col(c)).alias(c) for c in names]
        )
    return got


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    damping: float = DAMPING,
    rounds: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Trust and distrust of every host: ``(host, trust, distrust)``.

    ``edges`` holds ``(source, target, weight)`` once per pair, ``seeds`` ``(host, trust, distrust)`` once per
    host. A host passes its trust on to its targets, and its distrust back to its sources, in proportion
    to the links. A host without links keeps its seed. Scores are in units of a seed that nothing reaches.
    """
    names = ["trust", "distrust"]
    reached = _received(edges, seeds, names[:1], names[1:], damping, rounds, tolerance)
    return seeds.select("host", *names).union(reached).groupBy("host").agg(*[F.sum(c).alias(c) for c in names])


def balance(edges: DataFrame, seeds: DataFrame, **kwargs) -> DataFrame:
    """Distrust less trust of every host of ``seeds``, from -1 to 1: ``(host, balance)``.

    ``edges`` and ``seeds`` as for ``propagate``. Of the share of its urls that no rule judges, a host
    is held for what reaches it over links: distrust, and trust, as shares of what the same hosts would
    send if all their urls were blocked, or allowed. Hosts without a judged url send nothing.
    """
    edges = checkpointed(edges)
    own = F.col("distrust") - F.col("trust")
    if edges.isEmpty():
        return seeds.select("host", own.alias("balance"))
    judged = (F.col("trust") + F.col("distrust") > 0).cast("double")
    four = seeds.select("host", "trust", "distrust", judged.alias("all_trust"), judged.alias("all_distrust"))
    reached = _received(edges, four, ["trust", "all_trust"], ["distrust", "all_distrust"], **kwargs)

    def share(score: str) -> Column:
        most = F.col(f"all_{score}")
        return F.when(most > LEAST, F.least(F.lit(1.0), F.col(score) / most)).otherwise(0.0)

    spread = reached.select("host", (share("distrust") - share("trust")).alias("spread"))
    return seeds.join(spread, "host").select(
        "host", (own + (1 - F.col("trust") - F.col("distrust")) * F.col("spread")).alias("balance")
    )


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, margin: float = MARGIN, **kwargs
) -> DataFrame:
    """Verdict on every page's url: ``page_id, host, path, rule, verdict``.

    The verdicts of heavy hosts, fewer than ``HEAVY`` by their share of the urls, are written into the
    plan; only the urls of other hosts that no rule judges meet their host's verdict in a join.
    """
    matched = checkpointed(match_rules(pages, rules))
    seeds = checkpointed(
        matched.groupBy("host").agg(
            _share("allow").alias("trust"), _share("block").alias("distrust"), F.count_if(F.col("verdict").isNull()).alias("open")
        )
    )
    edges = (
        matched.where("host != ''")  # what has no host is no host
        .select(F.col("host").alias("source"), F.explode("links").alias("target"))
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    hosts = checkpointed(
        balance(edges, seeds.drop("open"), **kwargs)
        .join(seeds.select("host", "open"), "host")
        .select("host", "open", (F.col("balance") > margin).alias("blocked"))
    )
    urls = hosts.agg(F.sum("open")).first()[0] or 0
    heavy = {h: blocked for h, _, blocked in hosts.where(F.col("open") * HEAVY > urls).collect()}
    blocked_heavy = F.col("host").isin([h for h, blocked in heavy.items() if blocked])
    settled = F.col("verdict").isNotNull() | F.col("host").isin(list(heavy))
    columns = ["page_id", "host", "path", "rule"]
    here = matched.where(settled).select(
        *columns, F.coalesce("verdict", F.when(blocked_heavy, "block"), F.lit("allow")).alias("verdict")
    )
    distrusted = hosts.where("blocked").select("host", F.lit("block").alias("spread"))
    others = matched.where(~settled).join(distrusted, "host", "left")
    return here.unionByName(others.select(*columns, F.coalesce("spread", F.lit("allow")).alias("verdict")))
