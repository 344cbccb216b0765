"""JSON records in any layout, found by many tasks inside one file.

A record is an outermost object ``{...}``: alone on its line, spread over lines, after one another with or without
commas, or inside an array; one file may mix them, and files of a folder need not agree. A file is read
as pieces that end at ``}``, so Spark can split it anywhere, a line of any length included.

Whether a brace counts depends on what came before: quotes may be open, and braces. Each split first
sums up what it does to that state, for both cases of the quote: by how much the depth changes and how low it
gets on the way, which is enough to put splits together in order. From the sums follows the state at
the start of every split. Then each split is read again and gives the records that lie within; what crosses a
border is put together by the split where the record begins.

A line end closes an open quote, as no JSON string holds one. An object that never ends is no
record: whole lines after its start that are objects by themselves, unindented, still count, if they do not
span more than two splits. Records that do not parse are left to the reader to skip.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpointed, shared_folder

_TOKEN = re.compile(r'\\.|["{\n]')
BROADCAST_SPLITS = 1 << 18  # states of more splits are joined by a shuffle


def _scan(piece: str, quoted: bool) -> tuple[int, int, bool]:
    """Objects opened, the place of the first, and whether a quote is open at the end."""
    opened, first = 0, -1
    for token in _TOKEN.finditer(piece):
        c = token.group()
        if c == '"':
            quoted = not quoted
        elif c == "\n":
            quoted = False
        elif c == "{" and not quoted:
            if not opened:
                first = token.start()
            opened += 1
    return opened, first, quoted


@dataclass
class _Sum:
    """What a split does: the change of depth, its lowest value after a ``}``, the quote at the end.

    ``before`` is the lowest value without the last ``}``, null where there is no other.
    """

    quoted: bool
    depth: int = 0
    lowest: int | None = None
    before: int | None = None

    def add(self, opened: int, quoted: bool) -> None:
        self.depth += opened
        self.quoted = quoted
        if not quoted:
            self.depth -= 1
            self.before = self.lowest
            self.lowest = self.depth if self.lowest is None else min(self.lowest, self.depth)


_FIELDS = {"quoted": "boolean", "depth": "long", "lowest": "long", "before": "long"}
_SUMS = "file string, block long, size long, bytes long, " + ", ".join(
    f"{k}{q} {kind}" for q in (0, 1) for k, kind in _FIELDS.items()
)
_STATE = "file string, block long, quoted boolean, depth long, owner long, following long, ended boolean, endless long"
_FOUND = "file string, kind string, at long, block long, value string"
RECORD, PART, LINE = "record", "part", "line"
_FLUSH = 8 << 20  # characters found before they are handed on


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each ``}``, in order within a split."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "}").text(path).select(
        "value", meta.file_path.alias("file"), meta.file_block_start.alias("block"), meta.file_size.alias("size")
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str], bool]]:
    """The next pieces of a split, named by file and block, and whether it starts with them."""
    current = None
    for batch in batches:
        texts, files, blocks, *rest = (c.to_pylist() for c in batch.columns)
        at = 0
        while at < len(texts):
            key, end = (files[at], blocks[at]), at + 1
            while end < len(texts) and blocks[end] == key[1] and files[end] == key[0]:
                end += 1
            yield (*key, *(c[at] for c in rest)), texts[at:end], key != current
            current, at = key, end


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split, for a quote that is closed and one that is open at its start."""
    sums: dict[tuple, tuple[_Sum, _Sum]] = {}
    size: dict[tuple, int] = {}
    for key, texts, new in _by_split(batches):
        if new:
            sums[key], size[key] = (_Sum(False), _Sum(True)), 0
        plain, quoted = sums[key]
        for text in texts:
            size[key] += len(text.encode()) + 1
            found = _scan(text, plain.quoted)
            other = found if plain.quoted == quoted.quoted else _scan(text, quoted.quoted)
            plain.add(found[0], found[2])
            quoted.add(other[0], other[2])
    rows = [
        {"file": key[0], "block": key[1], "size": key[2], "bytes": size[key]}
        | {f"{k}{q}": getattr(s, k) for q, s in enumerate(both) for k in _FIELDS}
        for key, both in sums.items()
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_arrow(_SUMS))


def _packed(file: str) -> bool:
    return file.rsplit(".", 1)[-1] in ("gz", "bz2", "zst", "lz4", "snappy", "deflate")


def _states(splits: list[dict]) -> list[dict]:
    """The state at the start of each split of one file, from all sums; ``owner`` is the split where the
    open record begins, ``endless`` the one with a record that never ends, else -1."""
    splits = sorted(splits, key=lambda b: b["block"])
    # a file that does not end in } has a last piece to which none belongs; a byte order mark is not read
    spare = sum(b["bytes"] for b in splits) - splits[0]["size"]
    ended = spare in (0, -3) or _packed(splits[0]["file"])
    quoted, depth, owner, out = False, 0, -1, []
    for k, b in enumerate(splits):
        last = k == len(splits) - 1
        following = -1 if last else splits[k + 1]["block"]
        out.append(
            {"file": b["file"], "block": b["block"], "quoted": quoted, "depth": depth, "owner": owner}
            | {"following": following, "ended": ended}
        )
        end, change, lowest, before = (b[f"{name}{int(quoted)}"] for name in _FIELDS)
        if last and not ended and not end:
            change, lowest = change + 1, before
        returns = depth == 0 or (lowest is not None and depth + lowest <= 0)
        depth += change
        if lowest is not None:
            depth = max(depth, change - lowest)  # a } too many does not count
        if depth and returns:
            owner = b["block"]
        quoted = end
    return [state | {"endless": owner if depth else -1} for state in out]


def _states_of_files(table: pa.Table) -> pa.Table:
    return pa.Table.from_pylist(_states(table.to_pylist()), schema=_arrow(_STATE))


class _Walk:
    """The pieces of one split from its known state on; hands out records and what crosses its borders."""

    def __init__(self, key: tuple, give) -> None:
        self.file, self.block, self.quoted, self.depth, self.owner, self.following, self.ended, self.endless = key
        if self.depth is None:
            raise ValueError(f"the splits of {self.file} changed while it was read")
        self.give = give
        self.inherited = self.depth > 0
        self.parts: list[str] = []
        self.waiting: str | None = None

    def add(self, text: str) -> None:
        if self.waiting is not None:
            self._piece(self.waiting, True)
        self.waiting = text

    def _piece(self, text: str, brace: bool) -> None:
        opened, first, self.quoted = _scan(text, self.quoted)
        if not self.depth:
            if not opened:
                return
            text, self.owner, self.inherited = text[first:], self.block, False
        self.parts.append(text + "}" if brace else text)
        self.depth += opened
        if brace and not self.quoted:
            self.depth -= 1
            if not self.depth:
                kind = PART if self.inherited else RECORD
                self.give(self.file, kind, self.owner, self.block, "".join(self.parts))
                self.parts, self.inherited = [], False

    def finish(self) -> None:
        self._piece(self.waiting, self.following >= 0 or self.ended)
        if not self.depth:
            return
        text = "".join(self.parts)
        if self.owner != self.endless:
            self.give(self.file, PART, self.owner, self.block, text)
            return
        lines = text.split("\n")
        if self.inherited and len(lines) > 1:
            self.give(self.file, LINE, self.block, self.block, lines.pop(0))
        if self.following >= 0 and len(lines) > 1:
            self.give(self.file, LINE, self.following, self.block, lines.pop())
        for line in lines:
            line = line.rstrip(", \t\r")
            if line.startswith("{") and _parses(line):
                self.give(self.file, RECORD, self.block, self.block, line)


def _parses(line: str) -> bool:
    try:
        json.loads(line)
        return True
    except ValueError:
        return False


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0

    def give(*row) -> None:
        nonlocal held
        rows.append(row)
        held += len(row[-1])

    def batch() -> pa.RecordBatch:
        schema = _arrow(_FOUND)
        out = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(out, schema=schema)

    walk = None
    for key, texts, new in _by_split(batches):
        if new:
            if walk:
                walk.finish()
            walk = _Walk(key, give)
        for text in texts:
            walk.add(text)
            if held > _FLUSH:
                yield batch()
                rows, held = [], 0
    if walk:
        walk.finish()
    if rows:
        yield batch()


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Hold what Spark derives the number of splits from, should executors come or go in between."""
    name = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(name, None)
    spark.conf.set(name, old or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)


def to_lines(spark: SparkSession, path: str) -> str:
    """Write every record below ``path`` as a line of its own to the shared folder; returns the folder."""
    with _same_splits(spark):
        pieces = _pieces(spark, path)
        sums = checkpointed(pieces.select("value", "file", "block", "size").mapInArrow(_summed, _SUMS))
        states = checkpointed(sums.groupBy("file").applyInArrow(_states_of_files, _STATE))
        if states.count() <= BROADCAST_SPLITS:
            known = pieces.drop("size").join(F.broadcast(states), ["file", "block"], "left")
        else:
            numbered = pieces.drop("size").withColumn("__seq", F.monotonically_increasing_id())
            known = numbered.join(states, ["file", "block"], "left").sortWithinPartitions("file", "block", "__seq")
        columns = ["value", *[f.split()[0] for f in _STATE.split(", ")]]
        found = checkpointed(known.select(*columns).mapInArrow(_found, _FOUND))
    whole = found.where(F.col("kind") == RECORD).select("value")
    in_order = F.sort_array(F.collect_list(F.struct("block", "value")))
    joined = (
        found.where(F.col("kind") != RECORD)
        .groupBy("file", "kind", "at")
        .agg(in_order.alias("parts"))
        .where((F.col("kind") == PART) | (F.size("parts") == 2))  # a line that spans more than two splits is lost
        .select("kind", F.array_join("parts.value", "").alias("value"))
    )
    line = F.rtrim(F.col("value"), F.lit(", \t\r"))
    lines = joined.where(F.col("kind") == LINE).select(line.alias("value")).where(F.col("value").startswith("{"))
    records = whole.unionByName(joined.where(F.col("kind") == PART).select("value")).unionByName(lines)
    folder = f"{shared_folder(spark)}/json-{uuid.uuid4().hex[:12]}"
    records.select(F.translate("value", "\n\r", "  ").alias("value")).write.text(folder)
    return folder
