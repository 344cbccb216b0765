"""Near-duplicate groups by SimHash fingerprints and pigeonring filtering.

A fingerprint has 64 bits: a bit is set if more than half of the hashes of the text's word shingles
set it. Two fingerprints link if they differ in at most ``max_distance`` bits; linked documents and
those they reach form a group, named by its smallest id.

Exact copies of a fingerprint are one node. The 64 bits are cut into ``max_distance + 1`` segments
on a ring. If two fingerprints link, some segment starts a chain in which the first ``l`` segments
together differ in at most ``l * max_distance / segments`` bits for every ``l``; the first budget is
below one bit, so that segment is equal and serves as join key, and the chain is checked before the
full distance. Where more than ``BUCKET`` fingerprints share a segment, pairs are not formed:
each emits the words within half the distance of it, and fingerprints that meet at such a word
are linked to the smallest one there. Two fingerprints meet exactly if they link, so no link is lost
between groups, and at most 65 meet at a word when the distance is two.

Null and empty texts have fingerprint zero and link like any other. Rows without an id have their
fingerprint and group; they never name one (a group without any id is named null). Repeated rows
are one node. An empty table gives an empty one.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import map_batches
from tidemark.session import checkpointed

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
BUCKET = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().translate(_LOWER).split()  # at ASCII white space only
    if not words:
        return 0
    if len(words) > shingle:
        grams = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
    else:
        grams = [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=SEED), grams), "<u8", n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    whole = n - n % 255  # sums of 255 bits fit a byte
    counts = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fingerprint``, the 64 bits as a signed number."""

    def make():
        def step(doc_ids, texts):
            prints = [fingerprint_of(t, shingle) for t in texts]
            return {"doc_id": doc_ids, "fingerprint": [p - (1 << 64) if p >> 63 else p for p in prints]}

        return step

    return map_batches(docs, ["doc_id", "text"], make, "doc_id long, fingerprint long")


def _masks(max_distance: int) -> list[int]:
    """The ring's segments as masks, as equal as can be."""
    m = max_distance + 1
    ends = [64 * k // m for k in range(m + 1)]
    masks = [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(ends, ends[1:])]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def _chain(one: Column, two: Column, segment: Column, max_distance: int) -> Column:
    """The chain from ``segment`` stays within its budgets, and so does the full distance."""
    masks, differing = _masks(max_distance), one.bitwiseXOR(two)
    m = len(masks)
    out = F.lit(False)
    for first in range(m):
        seen, fits = 0, F.lit(True)
        for length in range(1, m + 1):
            seen |= masks[(first + length - 1) % m]
            fits = fits & (F.bit_count(differing.bitwiseAND(F.lit(seen))) <= length * max_distance // m)
        out = F.when(segment == first, fits).otherwise(out)
    return out


def _within(fingerprint: Column, radius: int) -> Column:
    """All words within ``radius`` bits of a fingerprint."""
    words = F.array(fingerprint)
    for _ in range(radius):
        words = F.array_distinct(
            F.flatten(
                F.transform(
                    words,
                    lambda w: F.concat(
                        F.array(w), *[F.array(w.bitwiseXOR(F.lit((1 << b) - (1 << 64 if b == 63 else 0)))) for b in range(64)]
                    ),
                )
            )
        )
    return words


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links ``(one, two)``, ``one < two``, between distinct fingerprints.

    Of buckets up to ``bucket`` fingerprints every link is given; of larger ones enough of them
    that what is linked stays connected.
    """
    masks = F.array(*[F.lit(m) for m in _masks(max_distance)])
    keyed = checkpointed(
        prints.select(
            "fingerprint",
            F.posexplode(F.transform(masks, lambda m: F.col("fingerprint").bitwiseAND(m))).alias("segment", "key"),
        )
    )
    on = ["segment", "key"]
    sizes = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = keyed.join(sizes, on)
    small = sized.where(F.col("n") <= bucket).drop("n")
    other = small.withColumnRenamed("fingerprint", "two")
    pairs = (
        small.withColumnRenamed("fingerprint", "one")
        .join(other, on)
        .where((F.col("one") < F.col("two")) & _chain(F.col("one"), F.col("two"), F.col("segment"), max_distance))
        .select("one", "two")
    )
    crowded = sized.where(F.col("n") > bucket).select("fingerprint").distinct()
    near, far = max_distance // 2, max_distance - max_distance // 2
    meet = crowded.select("fingerprint", F.explode(_within(F.col("fingerprint"), far)).alias("word"))
    if near == far:
        centres = meet.groupBy("word").agg(F.min("fingerprint").alias("one"))
    else:
        # a link has one end within the smaller radius of the word and one within the larger
        centres = (
            crowded.select("fingerprint", F.explode(_within(F.col("fingerprint"), near)).alias("word"))
            .groupBy("word")
            .agg(F.min("fingerprint").alias("one"))
        )
    starred = (
        meet.join(centres, "word")
        .where(F.col("one") != F.col("fingerprint"))
        .select(F.least("one", "fingerprint").alias("one"), F.greatest("one", "fingerprint").alias("two"))
    )
    return pairs.unionByName(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Root of each linked node: ``(node, root)``, the root its component's smallest node.

    Each round a node takes the smallest root among its neighbours', then its root's root; paths
    shrink by halves or better. Rounds end when no root changes. A node has a bounded number of
    neighbours here; the shared root is looked up by a join that adaptive execution can split.
    """
    both = checkpointed(
        edges.select(F.col("one").alias("node"), F.col("two").alias("other")).union(
            edges.select(F.col("two").alias("node"), F.col("one").alias("other"))
        )
    )
    roots = checkpointed(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
    while True:
        seen = (
            both.join(roots.select(F.col("node").alias("other"), "root"), "other")
            .groupBy("node")
            .agg(F.min("root").alias("least"))
        )
        hooked = roots.join(seen, "node").select("node", F.col("root").alias("was"), F.least("root", "least").alias("root"))
        parents = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = checkpointed(
            hooked.join(parents, "root").select("node", F.least("root", "above").alias("root"), "was")
        )
        if jumped.where("root != was").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")


def _rooted(prints: DataFrame, max_distance: int, bucket: int) -> DataFrame:
    """Group of each distinct fingerprint: ``(fingerprint, root, component_id)``; ids may name several."""
    nodes = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(nodes, max_distance, bucket)).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(named, "root").select("fingerprint", "root", "component_id")


def groups(prints: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Group of each distinct fingerprint: ``(fingerprint, component_id)``."""
    return _rooted(prints, max_distance, bucket).select("fingerprint", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id``, ``fingerprint`` as 16 lower-case hex digits and ``component_id`` of every row."""
    prints = checkpointed(fingerprints(docs, shingle))
    found = groups(prints, max_distance, bucket)
    return prints.join(found, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


_TEXT, _ROW = "__simhash_text", "__simhash_row"


def _hashed(docs: DataFrame) -> DataFrame:
    """Add a hash of the text and one of the row, which tells rows of equal id and text apart."""
    told = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind]
    return docs.withColumns({_TEXT: F.xxhash64("text"), _ROW: F.xxhash64(F.lit(SEED), *told)})


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each group, with all columns: least id, nulls last, then by hash of text and of row.

    Rows that repeat an id but lie in different groups are different documents. A row with neither
    id nor text stays, as nothing says what it is a copy of.
    """
    unknown = F.col("doc_id").isNull() & F.col("text").isNull()
    known = _hashed(docs.where(~unknown))

    def make():
        def step(doc_ids, texts, *hashes):
            prints = [fingerprint_of(t, shingle) for t in texts]
            signed = [p - (1 << 64) if p >> 63 else p for p in prints]
            return dict(zip(("doc_id", _TEXT, _ROW, "fingerprint"), (doc_ids, *hashes, signed)))

        return step

    prints = checkpointed(
        map_batches(
            known, ["doc_id", "text", _TEXT, _ROW], make,
            f"doc_id long, {_TEXT} long, {_ROW} long, fingerprint long",
        )
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", _TEXT, _ROW)
    first = (
        prints.join(_rooted(prints, max_distance, BUCKET).select("fingerprint", "root"), "fingerprint")
        .groupBy("root")
        .agg(F.min(order).alias("first"))
        .select(f"first.{_TEXT}", f"first.{_ROW}")
    )
    on = [_TEXT, _ROW]
    kept = known.join(first, on, "left_semi").dropDuplicates(on).select(*docs.columns)
    return kept.unionByName(docs.where(unknown))
