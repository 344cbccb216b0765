"""Nearest neighbours by a block matrix join with quantised products.

Queries are dealt to groups of about ``QUERY_GROUP``, candidates to ``STRIPES`` stripes; a tile is
one group beside one stripe. A task holds the tile's queries and streams its candidates in
blocks. Vectors are quantised to 8-bit integers with a scale each, so one integer matrix product
per block gives every inner product up to an error that the residuals bound (Cauchy-Schwarz).
A pair is dropped only if even its upper bound lies below ``k`` certain scores of its query; the others
are recomputed on the original vectors in double precision, summed in order, and kept in a heap
per query. The heaps of a query, one per stripe, are then merged. Results are exact. Vectors whose products could
leave the range of doubles are divided by a power of two first, which loses nothing; pairs whose bounds leave
it all the same are recomputed.

Rows whose id is null, or whose vector is null, empty, zero or holds null or non-finite components,
take no part. Of rows that repeat an id the one whose vector has the smallest hash asks; all of them can be found,
but for the asking row itself, and equal rows are found as often as they stand there. A score that passes the
largest double is infinite; one that is not a number comes first, as in Spark's order.
Vectors are compared only with those of equal length. Ties go to the smaller id. Fewer than ``k``
candidates are all returned; an empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import checkpointed

K = 20
QUERY_GROUP = 4096
STRIPES = 16  # at least
STRIPE_ROWS = 1 << 16  # candidates in a stripe, on average
BLOCK_ROWS = 2048
PAIRS = 1 << 18  # pairs recomputed at once
SAFE_EXPONENT = 400  # squares and products of components below 2**400, and above 2**-400, stay in range
_EXACT = 1 << 24  # integers up to this are exact in single precision


class Quantised:
    """Vectors as 8-bit integers times a scale, with the norms that bound the error.

    ``exponent`` is the power of two a vector was divided by; scale and norms are those of what is left.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        largest = np.abs(vectors).max(axis=1)
        exponent = np.frexp(largest)[1]
        self.exponent = np.where(np.abs(exponent) < SAFE_EXPONENT, 0, exponent)
        if self.exponent.any():
            vectors = np.ldexp(vectors, -self.exponent[:, None])
        self.scale = np.abs(vectors).max(axis=1) / 127
        self.scale[self.scale == 0] = 1.0
        whole = np.rint(vectors / self.scale[:, None])
        self.codes = whole.astype(np.int8)
        approximate = whole * self.scale[:, None]
        self.norm = np.linalg.norm(vectors, axis=1)
        self.approximate_norm = np.linalg.norm(approximate, axis=1)
        self.residual = np.linalg.norm(vectors - approximate, axis=1)

    def bounds(self, other: Quantised) -> tuple[np.ndarray, np.ndarray]:
        """What the inner products of all pairs are at least and at most; infinite where doubles do not reach."""
        # the sums of int8 products are whole numbers, which the float product gives exactly
        kind = np.float32 if 127 * 127 * self.codes.shape[1] < _EXACT else np.float64
        whole = self.codes.astype(kind) @ other.codes.astype(kind).T
        near = whole * self.scale[:, None] * other.scale[None, :]
        error = np.outer(self.approximate_norm, other.residual) + np.outer(self.residual, other.norm)
        error += 1e-12 * np.outer(self.norm, other.norm)
        power = self.exponent[:, None] + other.exponent[None, :]
        if not power.any():
            return near - error, near + error
        with np.errstate(over="ignore", under="ignore"):
            least, most = np.ldexp(near - error, power), np.ldexp(near + error, power)
        far = power > 1000 - self.codes.shape[1].bit_length()  # a sum of products may pass the range on its way
        tiny = np.finfo(float).tiny * self.codes.shape[1]  # products below the range are rounded one by one
        return np.where(far, -np.inf, least - tiny), np.where(far, np.inf, most + tiny)


def exact(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, summed in the order of the components."""
    out = np.zeros(len(one))
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        for j in range(one.shape[1]):
            out += one[:, j] * two[:, j]
    return out


class Tile:
    """A group of queries with a heap each, fed with blocks of candidates."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.quantised = Quantised(vectors)
        self.heaps: list[list[tuple[bool, float, int, float]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)  # k-th score so far

    def add(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> None:
        """Candidates, each of which stands for so many equal rows; the asking row is not among its own."""
        least, most = self.quantised.bounds(Quantised(vectors))
        own = np.zeros(least.shape, bool)
        for i, j in zip(*np.nonzero(self.ids[:, None] == ids[None, :])):
            own[i, j] = np.array_equal(self.vectors[i], vectors[j])
        alone = own & (copies == 1)[None, :]
        bound = self.least
        if len(ids) >= self.k:
            certain = np.where(alone, -np.inf, least)
            bound = np.maximum(bound, np.partition(certain, -self.k, axis=1)[:, -self.k])
        rows, at = np.nonzero((most >= bound[:, None]) & ~alone)
        for i in range(0, len(rows), PAIRS):
            r, c = rows[i : i + PAIRS], at[i : i + PAIRS]
            scores = exact(self.vectors[r], vectors[c])
            better = ~(scores < self.least[r])
            r, c, scores = r[better], c[better], scores[better]
            times = np.minimum(copies[c] - own[r, c], self.k)
            for row, score, vec_id, n in zip(r.tolist(), scores.tolist(), ids[c].tolist(), times.tolist()):
                heap = self.heaps[row]
                found = (True, 0.0, -vec_id, score) if score != score else (False, score, -vec_id, score)
                for _ in range(n):
                    if len(heap) < self.k:
                        heapq.heappush(heap, found)
                    else:
                        heapq.heappushpop(heap, found)
                if len(heap) == self.k:
                    self.least[row] = np.inf if heap[0][0] else heap[0][1]

    def found(self) -> pa.RecordBatch:
        rows = [(q, -f[2], f[3]) for q, heap in zip(self.ids.tolist(), self.heaps) for f in heap]
        q, v, s = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
            names=["query_id", "vec_id", "score"],
        )


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _search_tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, key, held = None, None, []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))))
            start = 0
            while start < batch.num_rows:
                size, at, candidate = keys[start]
                stop = start + 1
                while stop < batch.num_rows and keys[stop] == keys[start]:
                    stop += 1
                part = batch.slice(start, stop - start)
                block = part.column(3).to_numpy(), part.column(4).to_numpy(), _matrix(part.column(5))
                start = stop
                if (size, at) != key:
                    if tile is not None:
                        yield tile.found()
                    tile, key, held = None, (size, at), []
                if not candidate:
                    held.append(block)
                    continue
                if held:
                    tile = Tile(*(np.concatenate(x) for x in zip(*held)), k)
                    held = []
                if tile is not None:  # else no query of this length is in the tile
                    tile.add(*block)
        if tile is not None:
            yield tile.found()

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding, copies)``: finite vectors other than zero, equal rows as one."""
    infinite = float("inf")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return (
        vectors.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
        .groupBy("vec_id", "embedding")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The ``k`` rows of largest inner product for each query row, nearest first.

    ``is_query`` is a condition on ``vec_id``. Columns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    rows = checkpointed(usable(vectors).withColumn("size", F.size("embedding")))
    asking = F.min_by(F.struct("size", "embedding"), F.struct(F.xxhash64("embedding"), "embedding")).alias("row")
    queries = rows.where(is_query).groupBy("vec_id").agg(asking).select("vec_id", "row.*", F.lit(1).cast("long").alias("copies"))
    groups = max(1, -(-queries.count() // QUERY_GROUP))
    stripes = max(STRIPES, -(-rows.count() // STRIPE_ROWS))
    group = F.pmod(F.xxhash64("vec_id"), F.lit(groups))
    stripe = F.pmod(F.xxhash64(F.lit(1), "vec_id", "embedding"), F.lit(stripes))
    all_groups = F.sequence(F.lit(0), F.lit(groups - 1))
    all_stripes = F.sequence(F.lit(0), F.lit(stripes - 1))
    tiles = queries.select(
        "size", F.explode(F.transform(all_stripes, lambda s: group * stripes + s)).alias("tile"),
        F.lit(False).alias("candidate"), "vec_id", "copies", "embedding",
    ).unionByName(
        rows.select(
            "size", F.explode(F.transform(all_groups, lambda g: g * stripes + stripe)).alias("tile"),
            F.lit(True).alias("candidate"), "vec_id", "copies", "embedding",
        )
    )
    heaps = (
        tiles.repartitionById(groups * stripes, F.col("tile").cast("int"))  # a task each
        .sortWithinPartitions("size", "tile", "candidate")
        .mapInArrow(_search_tiles(k), "query_id long, vec_id long, score double")
    )
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        heaps.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored)
WHERE rank <= 20
"""
