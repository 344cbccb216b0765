"""Exact k-nearest-neighbour means with missing coordinates.

Distance between two rows is ``sqrt(total / present * sum of squared differences)`` over the
coordinates both rows have. All pairs are never formed:

1. equal donor rows collapse to one with a count, equal receivers to one;
2. a fixed-size sample of donors gives each receiver an upper bound on its k-th distance;
3. coordinates are ordered, the widest first. Two rows meet on the first coordinate that both have:
   a donor is stored under each coordinate it has, a receiver looks under each it has and skips
   donors it meets on an earlier one. So no row visits all others because of a gap;
4. under a coordinate, donors are cut into cells along it and along a second one. A receiver visits
   the cells within its bound (a donor further off on one coordinate is further off overall), so no
   true neighbour is lost;
5. a cell with too many donors or visitors is split, and each part returns at most k candidates per
   receiver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpointed

SAMPLE = 1024
BLOCK_ROWS = 20_000
SECOND_CELLS = 8
PAIRS = 4_000_000  # distances held at once


def _distances(receivers: np.ndarray, donors: np.ndarray, total: int) -> np.ndarray:
    """Receivers x donors distances; infinity where no coordinate is shared."""
    squares = np.zeros((len(receivers), len(donors)))
    present = np.zeros((len(receivers), len(donors)))
    for j in range(receivers.shape[1]):
        gap = receivers[:, j, None] - donors[None, :, j]
        shared = ~np.isnan(gap)
        squares += np.where(shared, gap * gap, 0.0)
        present += shared
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(present > 0, np.sqrt(squares * total / present), np.inf)


def _chunks(n: int, width: int):
    step = max(1, PAIRS // max(1, width))
    return [slice(i, min(i + step, n)) for i in range(0, n, step)]


def _reach(receivers: np.ndarray, sample: np.ndarray, count: np.ndarray, k: int, total: int) -> np.ndarray:
    """Upper bound on each receiver's k-th distance; infinity where the sample gives none."""
    out = np.full(len(receivers), np.inf)
    for part in _chunks(len(receivers), len(sample)):
        distance = _distances(receivers[part], sample, total)
        order = np.argsort(distance, axis=1)
        enough = np.cumsum(count[order], axis=1) >= k
        at = enough.argmax(axis=1)
        rows = np.arange(len(distance))
        out[part] = np.where(enough[:, -1], distance[rows, order[rows, at]], np.inf)
    return out


def _candidates(receivers: np.ndarray, donors: np.ndarray, earlier: list[int], k: int, total: int):
    """Row and donor indexes of the k closest donors of each receiver, donors given by target.

    Donors that share one of the ``earlier`` coordinates with a receiver are left to it.
    """
    rows, found, distances = [], [], []
    for part in _chunks(len(receivers), len(donors)):
        x = receivers[part]
        distance = _distances(x, donors, total)
        for j in earlier:
            distance[np.ix_(~np.isnan(x[:, j]), ~np.isnan(donors[:, j]))] = np.inf
        last = np.partition(distance, k - 1, axis=1)[:, k - 1] if distance.shape[1] > k else np.inf
        r, d = np.nonzero((distance <= np.reshape(last, (-1, 1))) & np.isfinite(distance))
        order = np.lexsort((d, distance[r, d], r))
        r, d = r[order], d[order]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        kept = place < k
        rows.append(r[kept] + part.start)
        found.append(d[kept])
        distances.append(distance[r[kept], d[kept]])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(distances)


def _position(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges not above the value."""
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.lit(list(edges)), lambda e: e <= value))


def _edges(values: np.ndarray, cells: int) -> list[float]:
    """Distinct cuts of a coordinate into about equally full cells, by its sampled values."""
    known = np.sort(values[~np.isnan(values)])
    cuts = [known[i * len(known) // cells] for i in range(1, cells)] if len(known) else []
    return [float(e) for e in dict.fromkeys(cuts)]


def neighbour_means(
    receivers: DataFrame,
    donors: DataFrame,
    coordinates: Sequence[str],
    target: str,
    k: int = 5,
    total: int | None = None,
) -> DataFrame:
    """Mean target of the k nearest donors for every distinct receiver position.

    Returns the coordinates and ``neighbour_mean``. ``total`` is the coordinate count that
    distances are scaled to. Equal distances are taken in order of target value; copies of a
    position count as often as they occur, at their mean. A receiver that shares no coordinate with
    any donor is left out.
    """
    coordinates = list(coordinates)
    total = total or len(coordinates)
    names = [f"x{i}" for i in range(len(coordinates))]
    as_x = [F.col(c).cast("double").alias(n) for c, n in zip(coordinates, names)]
    # donors are read several times below, so they are written once
    points = checkpointed(
        donors.where(F.col(target).isNotNull())
        .select(*as_x, F.col(target).cast("double").alias("y"))
        .groupBy(*names)
        .agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n"))
    )
    seekers = receivers.select(*as_x).distinct()

    spread = points.agg(
        F.count(F.lit(1)).alias("rows"),
        *[(F.stddev_pop(n) * F.count(n)).alias(n) for n in names],
    ).first()
    order = sorted(range(len(names)), key=lambda i: -(spread[names[i]] or 0.0))
    sample = points.orderBy(F.xxhash64(*names), *names).limit(SAMPLE).select(*names, "n").collect()
    sample_x = np.array([[np.nan if v is None else v for v in r[:-1]] for r in sample], float)
    sample_x = sample_x.reshape(len(sample), len(names))
    sample_n = np.array([r["n"] for r in sample], dtype=np.int64)
    # as many cells as blocks are wanted, never more than the sample can tell apart
    cells = int(min(max(1, len(sample) // 4), max(1, -(-spread["rows"] // BLOCK_ROWS))))
    edges = [_edges(sample_x[:, i], cells) for i in range(len(names))]
    coarse = [_edges(sample_x[:, i], min(cells, SECOND_CELLS)) for i in range(len(names))]
    second = {i: next((j for j in order if j != i), None) for i in order}

    def bound(batches):
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            out = _reach(x, sample_x, sample_n, k, total) if len(sample) else np.full(len(x), np.inf)
            yield pdf.assign(reach=out)

    x_schema = [T.StructField(n, T.DoubleType()) for n in names]
    bounded = seekers.mapInPandas(
        bound, T.StructType([*x_schema, T.StructField("reach", T.DoubleType())])
    )
    # a touch of slack keeps a neighbour exactly at the bound on this side of rounding
    slack = F.col("reach") * (1 + 1e-9) + 1e-9

    def around(i: int, at: list[float], gaps: bool) -> Column:
        """Cells of a coordinate within the bound; with ``gaps`` also that of donors without it."""
        value = F.col(names[i])
        free = value.isNull() | (F.col("reach") == float("inf"))
        low = F.when(free, 0).otherwise(_position(value - slack, at))
        high = F.when(free, len(at)).otherwise(_position(value + slack, at))
        inside = F.sequence(low, high)
        return F.concat(F.array(F.lit(-1)), inside) if gaps else inside

    def cell(i: int, first: Column, other: Column) -> Column:
        return F.struct(F.lit(i).alias("axis"), first.alias("first"), other.alias("other"))

    def visited(i: int) -> Column:
        j = second[i]
        others = F.array(F.lit(-1)) if j is None else around(j, coarse[j], True)
        pairs = F.transform(around(i, edges[i], False), lambda a: F.transform(others, lambda b: cell(i, a, b)))
        return F.when(F.col(names[i]).isNotNull(), F.flatten(pairs))

    def stored(i: int) -> Column:
        j = second[i]
        other = F.lit(-1)
        if j is not None:
            other = F.when(F.col(names[j]).isNull(), -1).otherwise(_position(F.col(names[j]), coarse[j]))
        return F.when(F.col(names[i]).isNotNull(), F.array(cell(i, _position(F.col(names[i]), edges[i]), other)))

    def exploded(df: DataFrame, cells_of) -> DataFrame:
        all_cells = F.flatten(F.array_compact(F.array(*[cells_of(i) for i in order])))
        return df.withColumn("cell", F.explode(all_cells)).select(*df.columns, "cell.*")

    visits = checkpointed(exploded(bounded, visited).drop("reach"))
    points = exploded(points, stored)
    block = ["axis", "first", "other"]
    # rows per cell, a bounded number of cells; parts only balance the work
    sizes = (
        points.groupBy(*block).agg(F.count(F.lit(1)).alias("donors"), F.lit(0).alias("visitors"))
        .unionByName(visits.groupBy(*block).agg(F.lit(0).alias("donors"), F.count(F.lit(1)).alias("visitors")))
        .groupBy(*block).agg(
            *[F.ceil(F.greatest(F.sum(c), F.lit(1)) / BLOCK_ROWS).cast("int").alias(f"{c}_parts") for c in ("donors", "visitors")]
        )
    )
    position = F.xxhash64(*names)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hashed = lambda n: F.pmod(position, F.col(n)).cast("int")
    columns = [*block, "donor_part", "visit_part"]
    points = points.join(sizes, block).select(
        *points.columns, hashed("donors_parts").alias("donor_part"), each("visitors_parts").alias("visit_part")
    )
    visits = visits.join(sizes, block).select(
        *visits.columns, hashed("visitors_parts").alias("visit_part"), each("donors_parts").alias("donor_part")
    )
    empty = pd.DataFrame({c: pd.Series(dtype=float) for c in [*names, "d", "y", "n"]})

    def closest(key, visitors: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(visitors) or not len(held):
            return empty
        held = held.sort_values("y", kind="stable")
        earlier = order[: order.index(key[0])]
        rows, found, distance = _candidates(
            visitors[names].to_numpy(dtype=float), held[names].to_numpy(dtype=float), earlier, k, total
        )
        near = held.iloc[found]
        return visitors[names].iloc[rows].assign(d=distance, y=near["y"].to_numpy(), n=near["n"].to_numpy())

    schema = ", ".join(f"{n} double" for n in names) + ", d double, y double, n bigint"
    candidates = (
        visits.groupBy(*columns).cogroup(points.groupBy(*columns)).applyInPandas(closest, schema)
    )
    # only the first k candidates can count, so the rest is cut before the shuffle
    of_receiver = W.partitionBy(*names).orderBy("d", "y")
    first = candidates.withColumn("__place", F.row_number().over(of_receiver)).where(F.col("__place") <= k)
    before = F.sum("n").over(of_receiver.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    used = F.greatest(F.lit(0), F.least(F.col("n"), F.lit(k) - F.col("before")))
    merged = (
        first.withColumn("before", before)
        .groupBy(*names)
        .agg(F.try_divide(F.sum(used * F.col("y")), F.sum(used)).alias("neighbour_mean"))
    )
    return merged.select(*[F.col(n).alias(c) for n, c in zip(names, coordinates)], "neighbour_mean")


def fill_from_neighbours(
    df: DataFrame, donors: DataFrame, columns: Sequence[str], targets: Sequence[str], k: int = 5
) -> DataFrame:
    """Fill nulls of each target with the mean of its k nearest donors over all ``columns``."""
    targets = list(targets)
    gap = F.greatest(*[F.col(t).isNull() for t in targets], F.lit(False))
    # rows without a gap pass by; only the others are shuffled
    whole = df.where(~gap).withColumns({t: F.col(t).cast("double") for t in targets})
    gappy = df.where(gap)
    for target in targets:
        coordinates = [c for c in columns if c != target]
        means = neighbour_means(
            df.where(F.col(target).isNull()), donors, coordinates, target, k, len(columns)
        )
        position = F.struct(*[F.col(c).cast("double").alias(c) for c in coordinates])
        means = means.select(
            position.alias(f"__at_{target}"),
            F.lit(True).alias(f"__seek_{target}"),
            F.col("neighbour_mean").alias(f"__mean_{target}"),
        )
        # a row that does not seek keeps its own position, so that it meets no partner and such
        # rows do not all meet in one shuffle partition
        gappy = gappy.withColumns(
            {f"__at_{target}": position, f"__seek_{target}": F.col(target).isNull()}
        ).join(means, [f"__at_{target}", f"__seek_{target}"], "left")
    gappy = gappy.withColumns(
        {t: F.coalesce(F.col(t).cast("double"), F.col(f"__mean_{t}")) for t in targets}
    )
    return whole.unionByName(gappy.select(df.columns))
