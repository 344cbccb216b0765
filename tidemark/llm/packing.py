"""Best-fit packing of documents into sequences, by large-item matching.

Lengths are whole numbers up to the capacity, so the pieces of a corpus are known, for packing,
by a table of at most ``capacity`` counts. The bins are planned from these counts alone; the
pieces then find their bin by their rank among pieces of the same length.

Empty and null texts are documents of one end token. A null id is packed like any other; repeated
rows are packed once each; which of several equally long pieces goes where is
free. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.llm.tokens import END_ID, shared, tokenizer_path
from tidemark.session import checkpointed

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Slot(NamedTuple):
    """Pieces of one length with ranks from ``rank`` on: one each in ``count`` sequences."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


class _Bins:
    """Open bins by remaining gap; bins of one gap are kept as ranges of sequence ids."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.gaps: list[int] = []
        self.sequences = 0

    def put_back(self, gap: int, first: int, count: int) -> None:
        if gap <= 0:
            return
        if not self.ranges[gap]:
            insort(self.gaps, gap)
        self.ranges[gap].append((first, count))

    def take(self, least: int, most_bins: int) -> tuple[int, int, int] | None:
        """Bins of the smallest gap that holds ``least``: gap, first sequence, count."""
        at = bisect_left(self.gaps, least)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        first, count = self.ranges[gap].pop()
        if count > most_bins:
            self.ranges[gap].append((first + most_bins, count - most_bins))
            count = most_bins
        elif not self.ranges[gap]:
            del self.gaps[at]
        return gap, first, count

    def open(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Slots for ``counts[length]`` pieces of each length.

    Of the pieces longer than a third of the capacity two at most share a bin: each, from the
    longest down, is matched with the longest one that still fits beside it. The shorter pieces
    go, longest first, into the smallest gap that holds them; a bin is opened when none does.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    given: dict[int, int] = defaultdict(int)
    bins, slots = _Bins(capacity), []

    def use(length: int, count: int, sequence: int, offset: int) -> None:
        slots.append(Slot(length, given[length], count, sequence, offset))
        given[length] += count
        left[length] -= count

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        if not left[longest]:
            large.pop()
            continue
        at = bisect_left(large, capacity - longest + 1) - 1
        while at >= 0 and (not left[large[at]] or large[at] == longest and left[longest] < 2):
            if not left[large[at]]:
                del large[at]
            at -= 1
        mate = large[at] if at >= 0 else None
        if mate is None:
            pairs, gap = left[longest], capacity - longest
        elif mate == longest:
            pairs, gap = left[longest] // 2, capacity - 2 * longest
        else:
            pairs, gap = min(left[longest], left[mate]), capacity - longest - mate
        first = bins.open(pairs)
        use(longest, pairs, first, 0)
        if mate is not None:
            use(mate, pairs, first, longest)
        bins.put_back(gap, first, pairs)

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            found = bins.take(length, left[length])
            if found is None:
                each = capacity // length
                count = max(1, left[length] // each)
                found = capacity, bins.open(count), count
            gap, first, count = found
            use(length, count, first, capacity - gap)
            bins.put_back(gap - length, first, count)
    return slots


def pieces_of(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Cut each document's ids, the end id included, into pieces of at most ``capacity``.

    The first piece takes what is left over, the others are full.
    """
    path = tokenizer or tokenizer_path()
    end = end_id.to_bytes(4, "little")

    def make():
        encode = shared(path)

        def step(doc_ids, texts):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(doc_ids, texts):
                ids = encode(text) + end
                n, start = len(ids) // 4, 0
                stop = n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * stop]))
                    start, stop = stop, stop + capacity
            return out

        return step

    return map_batches(docs, ["doc_id", "text"], make, PIECES)


def deal(pieces: DataFrame, parts: int) -> DataFrame:
    """Add ``part``, by a row's place in the checkpointed frame.

    The place is the same however often a task reads it, and even where many rows share an id, or are one
    row repeated, which no hash of their columns could tell apart.
    """
    return pieces.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with the sequence they go to and their place in it.

    Texts are encoded once and never shuffled. The driver gets one count per length, ``capacity``
    rows at most. Pieces are ranked within their length without a window over it: they are dealt
    to as many parts as there are shuffle partitions, each part is ranked on its own and
    starts after the parts before it.
    """
    spark = docs.sparkSession
    pieces = checkpointed(pieces_of(docs, capacity, tokenizer, end_id))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = deal(pieces, parts)
    counted = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    begins = counted.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = (
        dealt.withColumn("rank", F.row_number().over(inside) - 1)
        .join(begins, ["length", "part"])
        .select(*pieces.columns, (F.col("rank") + F.col("begin")).alias("rank"))
    )
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    keys = (slots[:, 0] << 44) + slots[:, 1]
    rank_at = len(pieces.columns)

    def place(batches):
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, rank_at))
            slot = slots[np.searchsorted(keys, (lengths << 44) + ranks, "right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:rank_at], pa.array(slot[:, 3] + ranks - slot[:, 1]), pa.array(slot[:, 4])],
                names=[*batch.schema.names[:rank_at], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
