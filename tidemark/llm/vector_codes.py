"""Codes for vectors: each of four parts becomes the number of its nearest codebook entry.

Nearest entries are found by slicing and intersecting. Along each coordinate of a part the entries are
sorted, and before every place stands a mask of the entries up to there (as many 64-bit words as the
entries need). A radius around a value is a slice of the sorted entries, two places whose masks differ by
exactly the entries inside; the masks of all coordinates are intersected. What is left lies in a cube
around the part and holds every entry within the radius, so distances are taken to those alone. The first
radius is the distance to the best of a few entries that lie next along some coordinate, so that the
nearest entry, and each that ties with it, is always inside: no entry is missed and no second try is needed.

Codebooks come from four rounds of integer averages. A task sums the parts per entry, Spark adds the
sums up; only codebooks, at most 256 entries a part, reach the driver and go out with the tasks.

Defined results: vectors that are null or hold null, NaN or infinite components are left out, and are in
no codebook. Components become ``floor(1024 * x)``, held within 2**62; distances are exact at any size (in
Python integers where 64 bits might not do) and a sum beyond 64 bits is given as the largest long. Shorter vectors count
as padded with zeros up to the longest, and that to a multiple of four. Codebooks start from the smallest
ids, equal ids in order of their vectors, null ids last; repeated rows all take part. With fewer than
256 vectors there are as many entries. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import checkpointed

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024.0
BOUND = 1 << 62  # of a scaled component
SAFE = 1 << 27  # below it, squares of differences over 512 coordinates fit in 64 bits
PIVOTS = 8  # coordinates whose next entry is tried for the first radius
BATCH = 2048
LARGEST = (1 << 63) - 1
SALTS = 256

Book = np.ndarray  # entries x coordinates of one part


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with a vector whose components are all finite numbers; only the columns needed."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "embedding", "label").where(F.col("embedding").isNotNull() & sound)


def _scaled(column: pa.Array, width: int) -> np.ndarray:
    """Integer components, a row per vector, padded with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values * SCALE), -float(BOUND), float(BOUND)).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return whole.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def _wide_enough(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as they are where sums of squares fit in 64 bits, else as Python integers."""
    if all(not a.size or (int(a.max()) < SAFE and int(a.min()) > -SAFE) for a in arrays):
        return arrays
    return tuple(a.astype(object) for a in arrays)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=1)


class Slices:
    """The entries of one part, sorted along each coordinate, with masks of the entries up to each place."""

    def __init__(self, book: Book) -> None:
        self.book = book
        entries, width = book.shape
        self.order = np.argsort(book, axis=0, kind="stable").T  # coordinate x place -> entry
        self.sorted = np.take_along_axis(book, self.order.T, axis=0).T.copy()
        words = -(-entries // 64)
        bit = np.zeros((entries, words), np.uint64)
        at = np.arange(entries)
        bit[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        # masks[c, k]: the k smallest entries along coordinate c
        self.masks = np.zeros((width, entries + 1, words), np.uint64)
        for c in range(width):
            self.masks[c, 1:] = np.bitwise_or.accumulate(bit[self.order[c]], axis=0)

    def first_radius(self, x: np.ndarray) -> np.ndarray:
        """Squared distance to the best of the entries that come next along some coordinates."""
        entries, width = self.book.shape
        best = _squares(x, self.book[np.zeros(len(x), np.int64)])
        for c in sorted({k * width // PIVOTS for k in range(PIVOTS)}):
            place = np.minimum(np.searchsorted(self.sorted[c], x[:, c]), entries - 1)
            best = np.minimum(best, _squares(x, self.book[self.order[c][place]]))
        return best

    def candidates(self, x: np.ndarray, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, entry), by row then entry, for all entries in the cube around each row."""
        radius = _roots(squared)
        inside = None
        for c in range(x.shape[1]):
            low = np.searchsorted(self.sorted[c], x[:, c] - radius, side="left")
            high = np.searchsorted(self.sorted[c], x[:, c] + radius, side="right")
            mask = self.masks[c][high] ^ self.masks[c][low]
            inside = mask if inside is None else inside & mask
        bits = np.unpackbits(inside.view(np.uint8), axis=1, bitorder="little")
        return np.nonzero(bits)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row, the lower one of equals, and its squared distance."""
        if not x.shape[1]:
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        x, book = _wide_enough(x, self.book)
        if book is not self.book and self.book.dtype != object:
            return Slices(book).nearest(x)
        row, entry = self.candidates(x, self.first_radius(x))
        squared = _squares(x[row], book[entry])
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])  # every row has a candidate
        least = np.minimum.reduceat(squared, first)
        hit = np.flatnonzero(squared == np.repeat(least, np.diff(np.r_[first, len(row)])))
        _, where = np.unique(row[hit], return_index=True)
        return entry[hit[where]], least


def _roots(squared: np.ndarray) -> np.ndarray:
    """Square roots, rounded up."""
    if squared.dtype == object:
        return np.array([math.isqrt(s - 1) + 1 if s else 0 for s in squared.tolist()], object)
    return np.ceil(np.sqrt(squared.astype(np.float64))).astype(np.int64) + 1


def _books(spark_rows: list, width: int) -> list[Book]:
    """First codebooks: the parts of the first vectors."""
    first = _scaled(pa.array([r.embedding for r in spark_rows], pa.list_(pa.float64())), width)
    return [p.copy() for p in np.split(first, PARTS, axis=1)]


def _in_batches(vectors: DataFrame, columns: list[str], fn, schema: str) -> DataFrame:
    """``fn()`` gives a step over (columns..., scaled vectors) and a last one; both give column lists."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        step, last = fn()
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                out = step(batch.slice(k, BATCH))
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        out = last()
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return vectors.select(*columns).mapInArrow(run, schema)


def _sums(vectors: DataFrame, books: list[Book], width: int) -> DataFrame:
    """Per part and entry: how many parts it is nearest to, and the sum of each coordinate."""
    size = width // PARTS

    def fn():
        slices = [Slices(b) for b in books]
        wide = any(int(abs(b).max(initial=0)) >= SAFE for b in books)
        entries = len(books[0])
        count = np.zeros((PARTS, entries), np.int64)
        total = np.zeros((PARTS, entries, size), object if wide else np.int64)

        def step(batch):
            nonlocal total
            x = _scaled(batch.column(0), width)
            if total.dtype != object and x.size and max(int(x.max()), -int(x.min())) >= SAFE:
                total = total.astype(object)
            for p, part in enumerate(np.split(x, PARTS, axis=1)):
                entry, _ = slices[p].nearest(part)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                count[p] += np.bincount(entry, minlength=entries)
                if len(used):
                    total[p, used] += np.add.reduceat(part[order].astype(total.dtype), first, axis=0)

        def last():
            part, entry = np.nonzero(count)
            sums = [[str(v) for v in row] for row in total[part, entry].tolist()]
            return {"part": part, "entry": entry, "n": count[part, entry], "sums": sums}

        return step, last

    # sums travel as decimal text, as they may pass 64 bits; Spark adds them as decimals of 38 digits
    partial = _in_batches(vectors, ["embedding"], fn, "part int, entry int, n long, sums array<string>")
    added = [F.sum(F.get("sums", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in range(size)]
    return partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added)


def train(vectors: DataFrame, rounds: int = ROUNDS) -> list[Book] | None:
    """Codebooks of the four parts; None for a table without usable vectors."""
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    if width is None:
        return None
    width = -(-width // PARTS) * PARTS
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding").asc(), F.col("label")]
    books = _books(vectors.orderBy(*order).limit(ENTRIES).select("embedding").collect(), width)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    size = width // PARTS
    for _ in range(rounds if size else 0):
        for r in _sums(vectors, books, width).collect():  # at most PARTS x ENTRIES rows
            books[r.part][r.entry] = [int(r[f"s{k}"]) // r.n for k in range(size)]
    return books


def books_digest(books: list[Book]) -> str:
    listed = ",".join(str(v) for b in books for v in b.reshape(-1).tolist())
    return hashlib.sha256(listed.encode()).hexdigest()


def encode(vectors: DataFrame, books: list[Book]) -> DataFrame:
    """``vec_id, label, code, error``: entry numbers in hex, and the sum of squared distances."""
    width = PARTS * books[0].shape[1]

    def fn():
        slices = [Slices(b) for b in books]

        def step(batch):
            x = _scaled(batch.column(2), width)
            found = [s.nearest(part) for s, part in zip(slices, np.split(x, PARTS, axis=1))]
            codes = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            error = [min(sum(map(int, e)), LARGEST) for e in zip(*[d.tolist() for _, d in found])]
            return {
                "vec_id": batch.column(0),
                "label": batch.column(1),
                "code": [row.tobytes().hex() for row in codes],
                "error": error,
            }

        return step, lambda: None

    kinds = dict(vectors.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return _in_batches(vectors, ["vec_id", "label", "embedding"], fn, schema)


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add the error summed over rows of the same label, null being a label of its own.

    Labels that hold many rows (more than one in 256, so at most 255 of them) are joined by label and one of
    ``SALTS`` parts, so that no task takes all rows of a label.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST)).cast("long")
    # a null label joins as (true, null -> any one value)
    key = [F.col("label").isNull().alias("__none"), F.coalesce(F.hash("label"), F.lit(0)).alias("__part")]
    sums = checkpointed(codes.groupBy("label").agg(F.count(F.lit(1)).alias("__n"), total.alias("label_error")))
    rows = sums.agg(F.sum("__n")).first()[0] or 0
    heavy = [r.label for r in sums.where(F.col("__n") * SALTS > rows).select("label").collect()]
    named = [h for h in heavy if h is not None]
    is_heavy = F.coalesce(F.col("label").isin(named), F.lit(None in heavy)) if named else (
        F.col("label").isNull() & F.lit(None in heavy)
    )
    salt = F.when(is_heavy, F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = codes.select("*", *key, salt.alias("__salt"))
    right = sums.select(
        F.col("label").alias("__label"), "label_error", key[0].alias("__none2"), key[1].alias("__part2"),
        F.explode(salts).alias("__salt2"),
    )
    same = (
        (F.col("__none") == F.col("__none2"))
        & (F.col("__part") == F.col("__part2"))
        & (F.col("__salt") == F.col("__salt2"))
        & F.col("label").eqNullSafe(F.col("__label"))
    )
    return left.join(right, same, "left").select("vec_id", "label", "code", "error", "label_error")


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every usable vector."""
    kept = usable(vectors)
    books = train(kept, rounds)
    if books is None:
        schema = f"vec_id {dict(vectors.dtypes)['vec_id']}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    codes = checkpointed(encode(kept, books))
    out = with_label_error(codes).drop("label")
    return out.withColumn("codebooks_sha256", F.lit(books_digest(books)))


def _round_sql(k: int) -> str:
    """One assignment and the codebooks after it; ``b{k}`` become ``b{k+1}``."""
    return f"""
 n{k} AS MATERIALIZED (SELECT id, part, min({_DISTANCE.format("v.e", "b.e")} * 256 + entry) AS d FROM p v JOIN b{k} b USING (part) GROUP BY id, part),
 m{k} AS (SELECT part, entry, pos, CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END AS x FROM (
  SELECT part, cast(d % 256 as integer) AS entry, pos, sum(e[pos]) AS s, count(*) AS n
  FROM n{k} JOIN p USING (id, part), range(1, len(e) + 1) r(pos) GROUP BY ALL)),
 b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM b{k} b
  LEFT JOIN (SELECT part, entry, list(cast(x as bigint) ORDER BY pos) AS e FROM m{k} GROUP BY part, entry) m USING (part, entry)),"""


_DISTANCE = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

SQL = f"""WITH w AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 p AS MATERIALIZED (SELECT id, part, e[part * len(e) // 4 + 1 : (part + 1) * len(e) // 4] AS e FROM w, range({PARTS}) q(part)),
 b0 AS MATERIALIZED (SELECT part, cast(id - 1 as integer) AS entry, e FROM p WHERE id <= {ENTRIES}),
 {"".join(_round_sql(k) for k in range(ROUNDS))}
 c AS (SELECT id, string_agg(format('{{:02x}}', d % 256), '' ORDER BY part) AS code, cast(sum(d // 256) as bigint) AS error
  FROM (SELECT id, part, min({_DISTANCE.format("v.e", "b.e")} * 256 + entry) AS d FROM p v JOIN b{ROUNDS} b USING (part) GROUP BY id, part) GROUP BY id),
 books AS (SELECT sha256(string_agg(x, ',' ORDER BY part, entry, pos)) AS books FROM (
  SELECT part, entry, pos, cast(e[pos] as varchar) AS x FROM b{ROUNDS}, range(1, len(e) + 1) r(pos)))
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) as bigint) AS label_error, books AS codebooks_sha256
 FROM w JOIN c USING (id), books"""
