"""Token ids in Arrow files of equal-length sequences.

Each file is in the Arrow IPC file format: the stream format with a footer that gives the place
of every batch. A batch holds ``BATCH`` sequences, each a fixed-size list of ids beside a
fixed-size list of mask bits (false: padding after the last document of the file), so sequence
``k`` is row ``k % BATCH`` of batch ``k // BATCH`` and is read without a copy. A second Arrow file
lists the documents: id, first place and number of ids. Ids take 16 bits where the vocabulary
allows.

Empty and null texts are documents of one end token; null ids come first; rows that repeat an id
are all written, in the order of their texts' hashes. An empty table gives no files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import file_system, map_batches, new_folder, publish, small_batches
from tidemark.llm.tokens import END_ID, shared, tokenizer_path

SEQUENCE = 1024
BATCH = 64
MANIFEST = "file long, docs long, ids long, wide boolean"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _schema(wide: bool, sequence: int) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


class _SequenceWriter:
    """Collect ids and write a batch whenever it is full."""

    def __init__(self, sink, wide: bool, sequence: int, end_id: int) -> None:
        self.schema, self.sequence, self.end_id = _schema(wide, sequence), sequence, end_id
        self.kind = np.uint32 if wide else np.uint16
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts, self.held = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.kind))
        self.held += len(ids)
        if self.held >= BATCH * self.sequence:
            ids = np.concatenate(self.parts)
            full = BATCH * self.sequence
            for at in range(0, len(ids) - full + 1, full):
                self._write(ids[at : at + full], full)
            self.parts, self.held = [ids[len(ids) - len(ids) % full :]], len(ids) % full

    def _write(self, ids: np.ndarray, real: int) -> None:
        arrays = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.sequence)
            for values in (ids, np.arange(len(ids)) < real)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.concatenate(self.parts)
            padding = np.full(-len(ids) % self.sequence, self.end_id, self.kind)
            self._write(np.concatenate([ids, padding]), len(ids))
        self.writer.close()


def _names(folder: str, file: int) -> tuple[str, str]:
    return f"{folder}/tokens-{file:06d}.arrow", f"{folder}/docs-{file:06d}.arrow"


def write(
    docs: DataFrame,
    folder: str,
    sequence: int = SEQUENCE,
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Write the ids of all documents in ascending id order; returns the manifest.

    The manifest is lazy and has a row per range partition, which is a file pair: the write runs
    when it is read. A task writes under a name of its own and renames at the end, so a lost or
    repeated task leaves one whole file.
    """
    path = tokenizer or tokenizer_path()
    small_batches(docs.sparkSession)
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        encode, end = shared(path), end_id.to_bytes(4, "little")
        wide = max(end_id + 1, encode.vocabulary) > 1 << 16
        task = TaskContext.get()
        file = task.partitionId()
        fs, place = file_system(folder)
        fs.create_dir(place, recursive=True)
        names = _names(place, file)
        drafts = [f"{n}.{task.taskAttemptId()}.draft" for n in names]
        n_docs = n_ids = 0
        with fs.open_output_stream(drafts[0]) as sink, fs.open_output_stream(drafts[1]) as listing:
            sequences = _SequenceWriter(sink, wide, sequence, end_id)
            index = pa.ipc.new_file(listing, DOCS)
            while batch is not None:
                starts, lengths = [], []
                for text in batch.column(1).to_pylist():
                    ids = np.frombuffer(encode(text) + end, "<u4")
                    sequences.add(ids)
                    starts.append(n_ids)
                    lengths.append(len(ids))
                    n_ids += len(ids)
                n_docs += batch.num_rows
                doc_ids = batch.column(0).cast(pa.int64())
                index.write_batch(
                    pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(lengths)], schema=DOCS)
                )
                batch = next(batches, None)
            sequences.close()
            index.close()
        for draft, name in zip(drafts, names):
            publish(fs, draft, name)
        yield pa.RecordBatch.from_pydict(
            {"file": [file], "docs": [n_docs], "ids": [n_ids], "wide": [wide]},
            schema=pa.schema([("file", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("wide", pa.bool_())]),
        )

    return ordered.mapInArrow(run, MANIFEST)


class TokenFile:
    """Random access to the sequences and documents of one file pair."""

    def __init__(self, folder: str, file: int, sequence: int = SEQUENCE) -> None:
        fs, place = file_system(folder)
        names = _names(place, file)
        # a local file is mapped, so ids are read in place
        sources = [
            pa.memory_map(n) if fs.type_name == "local" else fs.open_input_file(n) for n in names
        ]
        self.sequences, self.docs = (pa.ipc.open_file(s) for s in sources)
        self.sequence = sequence
        self._last: tuple[int, np.ndarray] | None = None

    def _batch(self, k: int) -> np.ndarray:
        if self._last is None or self._last[0] != k:
            self._last = k, self.sequences.get_batch(k).column(0).flatten().to_numpy()
        return self._last[1]

    def sequence_at(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``k``."""
        batch = self.sequences.get_batch(k // BATCH)
        ids, mask = (batch.column(i).slice(k % BATCH, 1).flatten() for i in (0, 1))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def spans(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids of places ``start`` to ``stop``, in views of one batch each."""
        full = BATCH * self.sequence
        while start < stop:
            k, at = divmod(start, full)
            upto = min(stop, (k + 1) * full)
            yield self._batch(k)[at : upto - k * full]
            start = upto

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        for k in range(self.docs.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self.docs.get_batch(k).columns))


def read_documents(spark: SparkSession, folder: str, manifest, sequence: int = SEQUENCE) -> DataFrame:
    """Documents as the files hold them: id, first place over all files, ids and their checksum.

    ``manifest`` are the manifest's rows, one per file. A task reads one file.
    """
    files = sorted((r["file"], r["ids"]) for r in manifest)
    begins, total = [], 0
    for _, ids in files:
        begins.append(total)
        total += ids
    names = [f for f, _ in files]

    def make():
        def step(at):
            out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for k in at:
                file = TokenFile(folder, names[k], sequence)
                for doc_id, start, n in file.documents():
                    crc = 0
                    for ids in file.spans(start, start + n):
                        crc = zlib.crc32(ids.astype("<u4"), crc)
                    out["doc_id"].append(doc_id)
                    out["start"].append(begins[k] + start)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(crc)
            return out

        return step

    return map_batches(
        spark.range(0, len(files), 1, max(1, len(files))),
        ["id"],
        make,
        "doc_id long, start long, n_tokens long, ids_crc32 long",
    )


def round_trip(docs: DataFrame, folder: str | None = None, sequence: int = SEQUENCE, **kwargs) -> DataFrame:
    """Write the token files and read every document back from them."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    manifest = write(docs, folder, sequence, **kwargs).select("file", "ids").collect()
    return read_documents(docs.sparkSession, folder, manifest, sequence)
