"""WARC archives: a writer that stores equal payloads once, and a Spark data source that reads them.

Archives hold one gzip member per record, next to an index with each member's place and type. The
data source plans parts of files from the index, skips members whose type a filter rules out, and
of the others unpacks the headers first; the payload is unpacked only where the headers pass every
pushed filter, and handed on only if asked for. Archives without an index are read as a whole,
member by member.

Null payloads are empty ones. A null url has no target header; control characters in an url are
percent-encoded. A page without an id is a response of its own with a name derived from its place, and
is read back with a null id. Rows that repeat id and payload are written once each, with equal roles. An
empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
)

from tidemark.llm.common import file_system, new_folder, publish, small_batches
from tidemark.session import checkpointed

MIN_BYTES = 0
PART_BYTES = 64 << 20  # compressed bytes of one read task
ROWS = 256  # records per batch of the reader
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
TEXTS = ("record_id", "record_type", "target_uri", "date", "refers_to")
SCHEMA = (
    "".join(f"{c} string, " for c in TEXTS)
    + "headers map<string,string>, payload_bytes long, payload_digest string, payload binary"
)
ARROW = pa.schema(
    [(c, pa.string()) for c in TEXTS]
    + [
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, name: str, date: str) -> bytes:
    """One record; ``name`` is the record's id where the page has none."""
    kind = "response" if refers_to is None else "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name if page_id is None else f'<urn:page:{page_id}>'}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        headers.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        headers += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_roles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, html`` and ``refers_to``, the largest page id with an equal payload.

    Roles are found on digests alone and joined back by page, so a payload that many pages share
    gathers no texts.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    digests = checkpointed(
        rows.where(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes))
        .select("page_id", "sha1")
        .distinct()
    )
    last = digests.groupBy("sha1").agg(F.max("page_id").alias("last_id"))
    roles = digests.join(last, "sha1").where("page_id < last_id")
    return rows.join(roles, ["page_id", "sha1"], "left").select("page_id", "url", "html", F.col("last_id").alias("refers_to"))


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> DataFrame:
    """Write an archive and its index per partition; returns the lazy manifest ``file, records``.

    A task writes under a name of its own and renames at the end, so a lost or repeated task leaves
    one whole archive.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        batch = next(batches, None)
        if batch is None:
            return
        fs, place = file_system(folder)
        fs.create_dir(place, recursive=True)
        task = TaskContext.get()
        name = f"{place}/pages-{task.partitionId():06d}.warc.gz"
        draft = f"{name}.{task.taskAttemptId()}.draft"
        n = at = 0
        with fs.open_output_stream(draft, compression=None) as sink, fs.open_output_stream(f"{draft}-index") as index:
            while batch is not None:
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{n}')}>"
                    member = _member(record(page_id, url, html.encode(), refers_to, own, date))
                    sink.write(member)
                    index.write(f"{at} {len(member)} {'response' if refers_to is None else 'revisit'}\n".encode())
                    at, n = at + len(member), n + 1
                batch = next(batches, None)
        publish(fs, f"{draft}-index", f"{name}.index")
        publish(fs, draft, name)
        yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64())})

    return with_roles(pages, min_bytes).mapInArrow(run, "file string, records long")


class Part(InputPartition):
    """Members of one file whose index lines start between two places, or the whole file if there is no index."""

    def __init__(self, file: str, start: int | None = None, stop: int | None = None) -> None:
        self.file, self.start, self.stop = file, start, stop


class Wanted(NamedTuple):
    """Pushed conditions: allowed record types (null: all), and tests of headers."""

    types: frozenset[str] | None = None
    headers: tuple = ()

    def takes(self, kind: str) -> bool:
        return self.types is None or kind in self.types

    def passes(self, headers: dict[str, str]) -> bool:
        return self.takes(headers.get("WARC-Type", "")) and all(test(headers) for test in self.headers)


COLUMN_HEADERS = {
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
}


class _HeaderTest:
    """A condition on one header; a missing header is null and fails."""

    def __init__(self, name: str, kind: str, value) -> None:
        self.name, self.kind, self.value = name, kind, value

    def __call__(self, headers: dict[str, str]) -> bool:
        found = headers.get(self.name)
        if found is None:
            return False
        if self.kind == "in":
            return found in self.value
        return self.kind == "present" or found.startswith(self.value)


def _header_of(column: tuple[str, ...]) -> str | None:
    if len(column) == 1:
        return COLUMN_HEADERS.get(column[0])
    return None


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool, verify: bool) -> None:
        self.path, self.payloads, self.verify = path, payloads, verify
        self.wanted = Wanted()

    def pushFilters(self, filters):
        """Take conditions on the record type and on headers; give the others back to Spark."""
        types, tests = None, []
        for f in filters:
            values = {EqualTo: lambda f: {f.value}, In: lambda f: set(f.value)}.get(type(f), lambda f: None)(f)
            column = getattr(f, "attribute", ())
            if column == ("record_type",) and (values is not None or isinstance(f, IsNotNull)):
                if values is not None:
                    types = values if types is None else types & values
            elif (header := _header_of(column)) and values is not None:
                tests.append(_HeaderTest(header, "in", values))
            elif (header := _header_of(column)) and isinstance(f, (IsNotNull, StringStartsWith)):
                tests.append(_HeaderTest(header, *(("present", None) if isinstance(f, IsNotNull) else ("prefix", f.value))))
            else:
                yield f
        self.wanted = Wanted(None if types is None else frozenset(types), tuple(tests))

    def partitions(self) -> list[Part]:
        """Parts of about ``PART_BYTES``: as many equal stretches of each file's index.

        The driver looks at the sizes of files only; a part's task reads its own stretch.
        """
        from pyarrow.fs import FileSelector, FileType

        fs, place = file_system(self.path)
        found = {i.path: i for i in fs.get_file_info(FileSelector(place, allow_not_found=True)) if i.type == FileType.File}
        parts = []
        for file in sorted(f for f in found if re.search(r"\.warc(\.gz)?$", f)):
            index = found.get(f"{file}.index")
            if index is None:
                parts.append(Part(file))
                continue
            n = -(-found[file].size // PART_BYTES)
            cuts = [index.size * k // n for k in range(n + 1)] if n else []
            parts += [Part(file, a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        return parts

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive
            return
        rows = []
        fs, _ = file_system(self.path)
        with fs.open_input_file(partition.file) as source:
            if partition.start is None:
                records = _all_records(source, partition.file)
            else:
                with fs.open_input_file(f"{partition.file}.index") as index:
                    members = [m for m in index_lines(index, partition.start, partition.stop) if self.wanted.takes(m[2])]
                records = _indexed(source, members, partition.file)
            for head, body in records:
                headers = parse_headers(head)
                if self.wanted.passes(headers):
                    rows.append(self._row(headers, body))
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    def _row(self, headers: dict[str, str], body) -> dict:
        kind = headers.get("WARC-Type")
        declared = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
        row = {"record_type": kind, "headers": headers, "payload_digest": declared, "payload": None}
        row |= {column: headers.get(header) for column, header in COLUMN_HEADERS.items()}
        is_http = headers.get("Content-Type", "").startswith("application/http")
        if kind == "revisit":  # the payload is elsewhere; its length is that of the answer seen
            length = _LENGTH.search(body.until(HTTP_END)[0])
            return row | {"payload_bytes": int(length[1]) if length else None}
        if not (self.payloads or self.verify or body.length is None):  # nobody asks for the payload itself
            http, ends = body.until(HTTP_END) if is_http else (b"", False)
            return row | {"payload_bytes": body.length - (len(http) + len(HTTP_END)) * ends if ends or not is_http else 0}
        block = body.whole()
        payload = block.partition(HTTP_END)[2] if is_http else block
        if self.verify and declared is not None and declared != (found := digest(payload)):
            raise ValueError(f"{row['record_id']}: payload digest {found}, header says {declared}")
        return row | {"payload_bytes": len(payload), "payload": payload if self.payloads else None}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([list(r[f.name].items()) if f.name == "headers" else r[f.name] for r in rows], f.type)
            for f in ARROW
        ],
        schema=ARROW,
    )


HTTP_END = b"\r\n\r\n"
_LENGTH = re.compile(rb"(?im)^content-length: *(\d+)")
_NAMES = {
    n.lower(): n
    for n in ("WARC-Type", "WARC-Payload-Digest", "Content-Type", "Content-Length", *COLUMN_HEADERS.values())
}


def parse_headers(head: bytes) -> dict[str, str]:
    """Headers of a record. Names match in any case and stand as they came first; repeats are joined by commas."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    values: dict[str, list[str]] = {}
    names: dict[str, str] = {}
    for name, _, value in (x.partition(":") for x in lines[1:] if x):
        low = name.strip().lower()
        names.setdefault(low, _NAMES.get(low, name.strip()))
        values.setdefault(low, []).append(value.strip())
    return {names[low]: ", ".join(v) for low, v in values.items()}


HEAD_BYTES = 2048


def index_lines(index, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    """``(offset, length, type)`` of the index lines that start from ``start`` to before ``stop``."""
    index.seek(max(start - 1, 0))
    data = index.read(stop - max(start - 1, 0))
    if start:  # the line that ends at or after the first byte belongs to the stretch before
        _, _, data = data.partition(b"\n")
    while data and not data.endswith(b"\n") and (more := index.read(64)):
        head, end, _ = more.partition(b"\n")
        data += head + end
    for line in data.decode().splitlines():
        at, length, kind = line.split(" ")
        yield int(at), int(length), kind


class _Member:
    """A packed member that is read and unpacked no further than asked."""

    def __init__(self, source, at: int, length: int, file: str) -> None:
        self.source, self.at, self.left, self.name = source, at, length, f"{file} at {at}"
        self.unpacker = zlib.decompressobj(31)
        self.data = b""
        self.head = b""
        self.length: int | None = None

    def _more(self, size: int) -> bool:
        """Unpack some more bytes; False at the end of the member."""
        while not self.unpacker.eof:
            packed = self.unpacker.unconsumed_tail
            if not packed and self.left:
                self.source.seek(self.at)
                packed = self.source.read(min(self.left, max(size, HEAD_BYTES)))
                if not packed:
                    return False
                self.at, self.left = self.at + len(packed), self.left - len(packed)
            found = self.unpacker.decompress(packed, size)
            if found:
                self.data += found
                return True
            if not packed:
                return False
        return False

    def until(self, mark: bytes) -> tuple[bytes, bool]:
        """What precedes a mark, and whether it was found within the block; nothing is used up."""
        searched = 0
        while (at := self.data.find(mark, searched)) < 0 and not self._done():
            searched = max(0, len(self.data) - len(mark) + 1)
            if not self._more(HEAD_BYTES):
                break
        inside = self.data if self.length is None else self.data[: self.length]
        return (inside[:at], True) if 0 <= at < len(inside) else (inside, False)

    def _done(self) -> bool:
        return self.length is not None and len(self.data) >= self.length

    def open(self) -> bytes:
        """The record's headers; its block follows."""
        head, found = self.until(HTTP_END)
        if not found:
            raise ValueError(f"{self.name}: the record ends within its headers")
        self.data = self.data[len(head) + len(HTTP_END) :]
        length = _LENGTH.search(head)
        self.length = int(length[1]) if length else None
        return head

    def whole(self) -> bytes:
        parts = [self.data]
        held = len(self.data)
        self.data = b""
        while (self.length is None or held < self.length) and self._more(1 << 20):
            parts.append(self.data)
            held, self.data = held + len(self.data), b""
        self.data = b"".join(parts)
        if self.length is None:
            return self.data
        if len(self.data) < self.length:
            raise ValueError(f"{self.name}: the record ends within its block")
        return self.data[: self.length]


def _indexed(source, members, file: str):
    """Headers of each member, and the member itself, of which no more is unpacked than asked."""
    for at, length, _ in members:
        member = _Member(source, at, length, file)
        yield member.open(), member


class _Block:
    """A block that was read whole."""

    def __init__(self, block: bytes) -> None:
        self.block, self.length = block, len(block)

    def until(self, mark: bytes) -> tuple[bytes, bool]:
        head, found, _ = self.block.partition(mark)
        return head, bool(found)

    def whole(self) -> bytes:
        return self.block


class _Unpacked:
    """Bytes of a file of gzip members, or of a plain file, read forward."""

    def __init__(self, source) -> None:
        self.source, self.data, self.unpacker = source, b"", None
        first = source.read(2)
        source.seek(0)
        self.packed = first == b"\x1f\x8b"
        self.tail = b""

    def more(self) -> bool:
        piece = self.tail or self.source.read(1 << 16)
        self.tail = b""
        if not piece:
            return False
        if not self.packed:
            self.data += piece
            return True
        if self.unpacker is None:
            self.unpacker = zlib.decompressobj(31)
        self.data += self.unpacker.decompress(piece)
        if self.unpacker.eof:
            self.tail, self.unpacker = self.unpacker.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        while mark not in self.data:
            if not self.more():
                return None
        out, _, self.data = self.data.partition(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.data) < n and self.more():
            pass
        out, self.data = self.data[:n], self.data[n:]
        return out


def _all_records(source, file: str):
    stream = _Unpacked(source)
    while (head := stream.until(HTTP_END)) is not None:
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        length = _LENGTH.search(head)
        wanted = int(length[1]) if length else 0
        block = stream.take(wanted)
        if len(block) < wanted:
            raise ValueError(f"{file}: the record ends within its block")
        yield head, _Block(block)
    if stream.data.strip(b"\r\n"):
        raise ValueError(f"{file}: the last record ends within its headers")


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; options ``path``, ``payloads`` (true) and ``verify`` (true)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        option = {k.lower(): v for k, v in self.options.items()}
        flag = lambda k: option.get(k, "true").lower() == "true"
        return WarcReader(option["path"], flag("payloads"), flag("verify"))


def read(spark: SparkSession, folder: str, payloads: bool = True, verify: bool = True) -> DataFrame:
    """Records of all archives of a folder; filters on type and headers reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    options = {"payloads": str(payloads).lower(), "verify": str(verify).lower()}
    return spark.read.format("warc").options(**options).load(folder)


def page_of(column: str):
    """Page id that a record id names; null for others."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives and read every record back from them."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write(pages, folder, min_bytes).count()
    return read(spark, folder, payloads=False).select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )
