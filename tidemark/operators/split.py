"""Out-of-time, stratified and bootstrap selection, all decided by a hash of the row key.

A row's place depends on its key alone, never on partitioning, so a recomputed task agrees with
the lost one, and copies of a key never straddle a split.
"""

from __future__ import annotations

from collections.abc import Callable
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_totals
from tidemark.settings import BOOTSTRAP_ROWS, FOLDS, SEED, TRAIN_RATIO

HASH_BITS = 62
_LEADING_BITS = 16
# prime, multiplier of the low and of the high half; products stay below 2**62
MIXERS = ((2147483647, 1597334677, 982451653), (2147483629, 1442695041, 715225739))


def key_hash(*keys: str, seed: int = SEED) -> Column:
    """Uniform number in [0, 2**62) from any key columns."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed)), 64 - HASH_BITS)


def integer_hash(key: Column, seed: int = SEED) -> Column:
    """Hash of an integer key in [0, 2**62): the key's two halves mixed modulo two primes.

    Keys below 2**31 never collide, as each residue tells them apart; larger ones only by chance.
    """
    whole = F.pmod(key.cast("bigint"), F.lit(1 << 62))
    low, high = whole.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(whole, 31)
    one, two = (F.pmod(low * F.lit(a) + high * F.lit(b) + F.lit(seed), F.lit(p)) for p, a, b in MIXERS)
    return one * F.lit(1 << 31) + two


def out_of_time(
    df: DataFrame, train_start, train_end, oot_start, oot_end, column: str = "snapshot_date"
) -> DataFrame:
    """Tag rows ``train_test`` or ``oot`` by date window (ends included), drop the rest."""
    day = F.col(column)

    def inside(low, high) -> Column:
        low, high = (d if isinstance(d, Column) else F.lit(d) for d in (low, high))
        return day.between(low.cast("date"), high.cast("date"))

    tag = F.when(inside(oot_start, oot_end), "oot").when(inside(train_start, train_end), "train_test")
    return df.withColumn("split", tag).where(F.col("split").isNotNull())


def _parts(
    df: DataFrame, label: str, hashed: Column, ends: Callable[[Column], list[Column]]
) -> DataFrame:
    """Add ``__part``: the consecutive share of its class, in hash order, that a row falls in.

    ``ends`` maps the class size to the number of rows up to the end of each part but the last.
    Classes may be few and huge, so nothing is ranked over a whole class: rows are counted per
    leading hash bits, and only the buckets that hold an end are searched by value. The cuts are
    one short array per class; assigning a row then needs no shuffle.
    """
    slim = df.select(F.col(label).alias("c"), hashed.alias("h"))
    slim = slim.withColumn("b", F.shiftright("h", HASH_BITS - _LEADING_BITS))
    counts = slim.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n"))
    in_class = W.partitionBy("c")
    running = in_class.orderBy("b").rowsBetween(W.unboundedPreceding, 0)
    counts = counts.withColumns(
        {"upto": F.sum("n").over(running), "size": F.sum("n").over(in_class)}
    )
    targets = (
        counts.select(
            "c", "b", "upto", "n", F.posexplode(F.array(*ends(F.col("size")))).alias("part", "end")
        )
        .where((F.col("end") <= F.col("upto")) & (F.col("end") > F.col("upto") - F.col("n")))
        .select("c", "b", "part", (F.col("end") - F.col("upto") + F.col("n")).alias("rank"))
    )
    near = (
        slim.join(targets, ["c", "b"])
        .groupBy("c", "part", "rank", "h")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_hash = W.partitionBy("c", "part").orderBy("h").rowsBetween(W.unboundedPreceding, 0)
    cuts = (
        near.withColumn("upto", F.sum("n").over(by_hash))
        .where(F.col("upto") >= F.col("rank"))
        .groupBy("c", "part")
        .agg(F.min("h").alias("cut"))
        .groupBy("c")
        .agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
        .agg(F.map_from_entries(F.collect_list(F.struct("c", "cuts"))).alias("m"))
    )
    placed = df.withColumns({"__h": hashed, "__m": cuts.scalar()}).withColumn(
        "__cuts", F.coalesce(F.try_element_at("__m", F.col(label)), F.array().cast("array<bigint>"))
    )
    part = F.size(F.filter("__cuts", lambda cut: F.col("__h") > cut))
    return placed.select(*df.columns, part.alias("__part"))


def stratified_split(
    df: DataFrame, label: str, hashed: Column, train_ratio: float = TRAIN_RATIO
) -> DataFrame:
    """Add ``split``: ``train`` for the first ceil(ratio * n) rows of each class, else ``test``."""
    percent = round(train_ratio * 100)
    parts = _parts(df, label, hashed, lambda n: [F.expr(f"({percent} * size + 99) div 100")])
    return parts.select(
        *df.columns, F.when(F.col("__part") == 0, "train").otherwise("test").alias("split")
    )


def stratified_folds(
    df: DataFrame, label: str, hashed: Column, k: int = FOLDS, fold: str = "fold"
) -> DataFrame:
    """Add a fold number 0..k-1; fold sizes differ by at most one row per class."""

    def ends(size: Column) -> list[Column]:
        return [F.expr(f"{j} * (size div {k}) + least({j}, size % {k})") for j in range(1, k)]

    parts = _parts(df, label, hashed, ends)
    return parts.select(*df.columns, F.col("__part").alias(fold))


def split_summary(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Rows and mean label (2 digits) per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(label), 2).alias("mean_label")
    )


def class_bootstrap(
    df: DataFrame, label: str, hashed: Column, rows: int = BOOTSTRAP_ROWS
) -> DataFrame:
    """Class-proportional draw with replacement of about ``min(rows, n)`` rows.

    Each row is repeated a Poisson number of times derived from its hash (the Poisson bootstrap),
    which needs one count per class and no shuffle. Class shares follow the population, class 1
    rounded down. Assign folds before drawing, so that copies of a row stay in one fold.
    """
    sizes = df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("ones")
        ).alias("s")
    ).scalar()
    df, columns = df.withColumn("__sizes", sizes), df.columns
    n, ones = F.col("__sizes.n"), F.col("__sizes.ones")
    total = F.least(F.lit(rows), n)
    draw_ones = F.floor(total * ones / n)
    rate = F.when(F.col(label) == 1, F.try_divide(draw_ones, ones)).otherwise(
        F.try_divide(total - draw_ones, n - ones)
    )
    # rate <= 1: the chance of more than 12 copies is below 2**-32
    drawn = df.withColumns(
        {"__u": hashed / F.lit(float(1 << HASH_BITS)), "__rate": F.least(rate, F.lit(1.0))}
    )
    weights = F.lit([1.0 / factorial(k) for k in range(12)])
    # inverse of the Poisson distribution function at the row's uniform number
    drawn = drawn.withColumn(
        "__copies",
        F.aggregate(
            weights,
            F.struct(
                F.lit(0).alias("copies"), F.lit(0.0).alias("below"), F.exp(-F.col("__rate")).alias("power")
            ),
            lambda acc, w: F.struct(
                (acc["copies"] + (F.col("__u") >= acc["below"] + acc["power"] * w).cast("int")).alias(
                    "copies"
                ),
                (acc["below"] + acc["power"] * w).alias("below"),
                (acc["power"] * F.col("__rate")).alias("power"),
            ),
            lambda acc: acc["copies"],
        ),
    )
    return (
        drawn.where(F.col("__copies") > 0)
        .select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("__copies"))).alias("__one"))
        .drop("__one")
    )


_PER_BUCKET = 16  # rows in a bucket of the exact draw, on average


def exact_bootstrap(
    df: DataFrame, label: str, hashed: Column, rows: int = BOOTSTRAP_ROWS, seed: int = SEED
) -> DataFrame:
    """Class-proportional draw with replacement of exactly ``min(rows, n)`` rows.

    Class 1 has its share of the population, rounded down, and all others the rest. Every draw is a uniform
    rank in its class, in order of ``hashed``, a uniform number in [0, 2**62) that tells rows apart. Rows are
    counted per leading bits of it; a running total places each draw in a bucket of a few rows, and only the
    rows of buckets with a draw are read again and ranked, equal ones as one. Draws depend on ``seed`` and the
    rows alone. Assign folds before drawing, so that copies of a row stay in one fold.
    """
    of_class = F.coalesce(F.col(label) == 1, F.lit(False))
    n, ones = df.agg(F.count(F.lit(1)), F.count_if(of_class)).first()
    total = min(rows, n)
    if not total:
        return df.limit(0)
    draw_ones = total * ones // n
    bits = min(HASH_BITS, (n // _PER_BUCKET).bit_length())
    placed = df.withColumns({"__one": of_class, "__h": hashed})
    placed = placed.withColumn("__b", F.shiftright("__h", HASH_BITS - bits) if bits else F.lit(0))
    sizes = placed.groupBy("__one", "__b").agg(F.count(F.lit(1)).alias("n"))
    buckets = running_totals(sizes, order="__b", sums=["n"], by=["__one"])

    size = F.when(F.col("__one"), F.lit(ones)).otherwise(F.lit(n - ones))
    uniform = F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 64 - HASH_BITS)
    draws = df.sparkSession.range(total).withColumn("__one", F.col("id") < draw_ones)
    draws = draws.withColumns({"__u": uniform, "__size": size}).withColumn(
        "__rank", F.expr(f"cast(__u as decimal(19,0)) * cast(__size as decimal(19,0)) div {1 << HASH_BITS}BD")
    )
    draws = draws.groupBy("__one", "__rank").agg(F.count(F.lit(1)).alias("__copies"))

    # both sides meet in stretches of ranks; there are at most as many as draws and buckets
    stretch = F.lit(max(16 * _PER_BUCKET, 16 * n // total))
    spans = buckets.withColumn("__first", F.col("cum_n") - F.col("n")).withColumn(
        "__s", F.explode(F.sequence(F.floor(F.col("__first") / stretch), F.floor((F.col("cum_n") - 1) / stretch)))
    )
    hits = draws.withColumn("__s", F.floor(F.col("__rank") / stretch)).join(spans, ["__one", "__s"])
    inside = (F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("cum_n"))
    hits = hits.where(inside).select("__one", "__b", (F.col("__rank") - F.col("__first")).alias("__rank"), "__copies")

    near = placed.join(hits.select("__one", "__b").distinct(), ["__one", "__b"], "left_semi")
    alike = near.groupBy("__one", "__b", "__h", *df.columns).agg(F.count(F.lit(1)).alias("__n"))
    in_bucket = W.partitionBy("__one", "__b").orderBy("__h", F.xxhash64(*df.columns)).rowsBetween(W.unboundedPreceding, 0)
    ranked = alike.withColumn("__upto", F.sum("__n").over(in_bucket))
    drawn = ranked.join(hits, ["__one", "__b"]).where(
        (F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__n"))
    )
    return drawn.select(*df.columns, F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))).alias("__o")).drop("__o")
