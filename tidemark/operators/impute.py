"""Missing-value imputation: ``fit_imputer`` once, then row-local fills with fitted literals.

The fit runs a few aggregations over the whole frame and brings back numbers per column (and
per missing-value pattern for the chained model). ``transform`` adds no shuffle except for the
neighbour strategy.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import unmask_missing
from tidemark.operators.knn import fill_from_neighbours
from tidemark.operators.ordering import bracket, exact_medians
from tidemark.operators.profile import known, modes
from tidemark.operators.project import numeric_columns
from tidemark.session import checkpointed
from tidemark.settings import ImputeRule

RIDGE = 1e-9


@dataclass(frozen=True)
class Chain:
    """Chained regressions on standardised columns: steps ``(column index, intercept, weights)``."""

    columns: list[str]
    mean: list[float]
    std: list[float]
    steps: list[tuple[int, float, list[float]]]

    def values(self) -> Column:
        """All columns after the chain, as one array in original units."""
        z = [
            (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, m, s in zip(self.columns, self.mean, self.std)
        ]
        state = F.array(*[F.coalesce(x, F.lit(0.0)) for x in z])
        absent = F.array(*[F.col(c).isNull() for c in self.columns])
        steps = F.from_json(
            F.lit(json.dumps([{"j": j, "b": b, "w": w} for j, b, w in self.steps])),
            "array<struct<j:int,b:double,w:array<double>>>",
        )

        def predict(row: Column, step: Column) -> Column:
            products = F.zip_with(row, step["w"], lambda v, w: v * w)
            return step["b"] + F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

        def visit(row: Column, step: Column) -> Column:
            return F.when(
                F.get(absent, step["j"]),
                F.transform(
                    row, lambda v, i: F.when(i == step["j"], predict(row, step)).otherwise(v)
                ),
            ).otherwise(row)

        return F.aggregate(steps, state, visit)

    def value(self, column: str, values: Column) -> Column:
        j = self.columns.index(column)
        return F.get(values, F.lit(j)) * F.lit(self.std[j]) + F.lit(self.mean[j])


def _replayed(fills: np.ndarray, missing: np.ndarray, steps) -> np.ndarray:
    """Fills of the patterns after further steps; ``fills[p]`` maps (1, observed values) to the row."""
    for j, intercept, weights in steps:
        full = np.array([intercept, *weights])
        at = missing[:, j]
        fills[at, j + 1] = np.einsum("k,pkl->pl", full, fills[at])
    return fills


def _unpacked(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Missing columns, sums of products and fills of a batch of patterns."""
    missing = np.array([[bit == "1" for bit in p] for p in batch.column(0).to_pylist()], bool)
    square = (batch.num_rows, d + 1, d + 1)
    products, fills = (
        c.flatten().to_numpy(zero_copy_only=False).reshape(square).copy() for c in batch.columns[1:3]
    )
    return missing.reshape(batch.num_rows, d), products, fills


def _column_gram(d: int, j: int, steps):
    """Sums of products of the filled rows in which column ``j`` is observed, per batch."""

    def run(batches):
        for batch in batches:
            missing, products, fills = _unpacked(batch, d)
            fills = _replayed(fills, missing, steps)[~missing[:, j]]
            gram = np.einsum("pik,pkl,pjl->ij", fills, products[~missing[:, j]], fills)
            yield pa.RecordBatch.from_pydict(
                {"cell": pa.array(range((d + 1) ** 2), pa.int32()), "v": pa.array(gram.ravel())}
            )

    return run


def _after_round(d: int, steps):
    """Patterns with their fills after a round, and how far the round moved them."""

    def run(batches):
        for batch in batches:
            missing, products, fills = _unpacked(batch, d)
            after = _replayed(fills.copy(), missing, steps)
            change = after - fills
            moved = np.einsum("pik,pkl,pil->p", change, products, change)
            rows = pa.array(list(after.reshape(batch.num_rows, -1)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), rows, pa.array(moved)], names=["pattern", "products", "fill", "moved"]
            )

    return run


_PATTERNS = "pattern string, products array<double>, fill array<double>"


def fit_chain(
    df: DataFrame,
    columns: Sequence[str],
    mean: dict[str, float],
    std: dict[str, float],
    max_iter: int = 10,
    tol: float = 1e-3,
) -> Chain:
    """Chained equations fitted from one scan.

    A filled row is a linear function of its observed values, so the rounds need no second look
    at the data: one aggregation gives, per pattern of missing columns, the sums of products of
    the observed values, and every regression of every round follows from those small matrices.
    The patterns stay in a table; a step brings back one matrix of as many rows as there are columns.
    Columns are visited from fewest to most missing; each is regressed (least squares with a
    trace of ridge) on all others over the rows where it is observed.
    """
    columns = list(columns)
    d = len(columns)
    means = [mean[c] for c in columns]
    stds = [std[c] if std[c] else 1.0 for c in columns]
    z = [
        F.coalesce((F.col(c).cast("double") - F.lit(m)) / F.lit(s), F.lit(0.0)).alias(f"z{i}")
        for i, (c, m, s) in enumerate(zip(columns, means, stds))
    ]
    absent = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    observed = df.select(absent.alias("pattern"), F.lit(1.0).alias("one"), *z)
    names = ["one", *(f"z{i}" for i in range(d))]
    pairs = {(i, j): F.sum(F.col(names[i]) * F.col(names[j])) for i in range(d + 1) for j in range(i, d + 1)}
    summed = observed.groupBy("pattern").agg(*[v.alias(f"s{i}_{j}") for (i, j), v in pairs.items()])
    square = F.array(*[F.col(f"s{min(i, j)}_{max(i, j)}") for i in range(d + 1) for j in range(d + 1)])
    patterns = checkpointed(
        summed.select(
            "pattern", square.alias("products"), F.lit(np.eye(d + 1).ravel().tolist()).cast("array<double>").alias("fill")
        )
    )
    missing = patterns.agg(
        *[F.sum(F.when(F.substring("pattern", j + 1, 1) == "1", F.col("products")[0])).alias(str(j)) for j in range(d)]
    ).first()
    n_missing = np.array([missing[str(j)] or 0.0 for j in range(d)])
    order = [int(j) for j in np.argsort(n_missing, kind="stable") if n_missing[j] > 0]
    steps = []
    for _ in range(max_iter):
        done = len(steps)
        for j in order:
            cells = patterns.mapInArrow(_column_gram(d, j, steps[done:]), "cell int, v double")
            gram = np.zeros((d + 1) ** 2)
            for r in cells.groupBy("cell").agg(F.sum("v").alias("v")).collect():
                gram[r["cell"]] = r["v"]
            gram = gram.reshape(d + 1, d + 1)
            others = [i for i in range(d + 1) if i != j + 1]
            ridge = np.eye(d) * RIDGE * max(gram[0, 0], 1.0)
            ridge[0, 0] = 0.0
            weights = np.linalg.lstsq(
                gram[np.ix_(others, others)] + ridge, gram[others, j + 1], rcond=None
            )[0]
            full = np.zeros(d + 1)
            full[others] = weights
            steps.append((j, float(full[0]), [float(w) for w in full[1:]]))
        after = checkpointed(patterns.mapInArrow(_after_round(d, steps[done:]), f"{_PATTERNS}, moved double"))
        moved = after.agg(F.sum("moved")).first()[0] or 0.0
        patterns = after.drop("moved")
        if np.sqrt(max(moved, 0.0) / max(n_missing.sum(), 1.0)) < tol:
            break
    return Chain(columns, means, stds, steps)


@dataclass(frozen=True)
class ColumnFit:
    feature: str
    is_numeric: bool
    missing_percentage: float
    strategy: str | None  # None: nothing was missing at fit time
    dropped: bool
    mean: float | None = None
    median: float | None = None
    mode: str | None = None
    std: float | None = None

    def fill(self):
        """Literal for this column's strategy, falling back to median / mode, then a constant."""
        if not self.is_numeric:
            return self.mode if self.mode is not None else "Unknown"
        by_strategy = {
            "mean": self.mean,
            "most_frequent": float(self.mode) if self.mode is not None else None,
            "constant": 0.0,
        }
        value = by_strategy.get(self.strategy, self.median)
        if value is None:
            value = self.median
        return 0.0 if value is None else value


@dataclass(frozen=True)
class Imputer:
    rule: ImputeRule
    fits: dict[str, ColumnFit]
    chain: Chain | None = None
    donors: DataFrame | None = field(default=None, compare=False)

    def transform(self, df: DataFrame) -> DataFrame:
        """Unmask, fill by strategy, then make sure nothing known at fit time stays missing."""
        df = unmask_missing(df)
        if not self.rule.keep_sparse:
            df = df.drop(*[f.feature for f in self.fits.values() if f.dropped])
        fits = [f for f in self.fits.values() if f.feature in df.columns]
        df = df.withColumns({f.feature: known(df, f.feature) for f in fits})
        by_neighbours = [f.feature for f in fits if f.strategy == "knn"]
        if by_neighbours:
            numeric = [f.feature for f in fits if f.is_numeric and not f.dropped]
            df = fill_from_neighbours(
                df, self.donors, numeric, by_neighbours, self.rule.knn_neighbors
            )
        fills = {}
        chained = [f for f in fits if f.strategy == "iterative"]
        if chained:
            any_missing = F.greatest(*[F.col(f.feature).isNull() for f in chained], F.lit(False))
            df = df.withColumn("__chain", F.when(any_missing, self.chain.values()))
        for f in fits:
            value = F.col(f.feature)
            if f.is_numeric:
                value = value.cast("double")
            if f.strategy == "iterative":
                value = F.coalesce(value, self.chain.value(f.feature, F.col("__chain")))
            sparse = f.dropped and self.rule.keep_sparse
            default = (0.0 if f.is_numeric else "Unknown") if sparse else f.fill()
            fills[f.feature] = F.coalesce(value, F.lit(default))
        return df.withColumns(fills).drop("__chain")

    def summary(self, spark: SparkSession) -> DataFrame:
        """Number of imputed features per strategy."""
        return (
            self.to_frame(spark)
            .where("strategy is not null")
            .groupBy("strategy")
            .agg(F.count(F.lit(1)).alias("features"))
        )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Fitted statistics as a table, one row per feature; ``chain`` holds the regressions."""
        chain = json.dumps(vars(self.chain)) if self.chain else None
        rows = [
            (
                f.feature, f.is_numeric, f.missing_percentage, f.strategy, f.dropped, f.mean,
                f.median, f.mode, f.std, chain if f.strategy == "iterative" else None,
            )
            for f in self.fits.values()
        ]
        return spark.createDataFrame(
            rows,
            "feature string, is_numeric boolean, missing_percentage double, strategy string, "
            "dropped boolean, mean double, median double, mode string, std double, chain string",
        )


def load_imputer(
    stats: DataFrame, rule: ImputeRule = ImputeRule(), donors: DataFrame | None = None
) -> Imputer:
    """Imputer from its statistics table (one row per feature)."""
    rows = stats.orderBy("feature").collect()
    fits = {
        r.feature: ColumnFit(
            r.feature, r.is_numeric, r.missing_percentage, r.strategy, r.dropped, r.mean,
            r.median, r.mode, r.std,
        )
        for r in rows
    }
    chains = [r.chain for r in rows if r.chain]
    chain = None
    if chains:
        parts = json.loads(chains[0])
        parts["steps"] = [(j, b, w) for j, b, w in parts["steps"]]
        chain = Chain(**parts)
    return Imputer(rule, fits, chain, donors)


def save_imputer(imputer: Imputer, spark: SparkSession, path: str) -> None:
    """Write statistics, rule and the donors of the neighbour strategy under one folder."""
    imputer.to_frame(spark).write.mode("overwrite").parquet(f"{path}/statistics")
    rule = spark.createDataFrame([(json.dumps(asdict(imputer.rule)),)], "value string")
    rule.write.mode("overwrite").text(f"{path}/rule")
    if imputer.donors is not None:
        imputer.donors.write.mode("overwrite").parquet(f"{path}/donors")


def read_imputer(spark: SparkSession, path: str) -> Imputer:
    """The imputer as it was saved."""
    rule = ImputeRule(**json.loads(spark.read.text(f"{path}/rule").first()["value"]))
    loaded = load_imputer(spark.read.parquet(f"{path}/statistics"), rule)
    if any(f.strategy == "knn" for f in loaded.fits.values()):
        loaded = replace(loaded, donors=spark.read.parquet(f"{path}/donors"))
    return loaded


def strategy_for(feature: str, is_numeric: bool, missing_pct: float, rule: ImputeRule) -> str:
    """Own rule of the feature, else the default of its kind.

    The numeric default holds while few values are missing; beyond that the median is used.
    """
    if feature in rule.per_feature:
        return rule.per_feature[feature]
    if not is_numeric:
        return rule.categorical
    return rule.numeric if missing_pct < rule.numeric_default_below_pct else "median"


def fit_imputer(
    df: DataFrame, rule: ImputeRule = ImputeRule(), columns: Sequence[str] | None = None
) -> Imputer:
    """Fit on ``columns`` (default all) of a training frame."""
    clean = unmask_missing(df.select(*columns) if columns else df)
    # every statistic reads these columns: run what stands above them once
    clean = checkpointed(clean.select(*[known(clean, c).alias(c) for c in clean.columns]))
    all_numeric = numeric_columns(clean)
    # counts, means, deviations and brackets of the middle of all columns in one scan
    row = clean.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in clean.columns],
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in all_numeric],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in all_numeric],
        *[bracket(F.col(c).cast("double")).alias(f"b_{c}") for c in all_numeric],
    ).first()
    missing = {c: row["rows"] - row[f"n_{c}"] for c in clean.columns}
    missing_pct = {c: missing[c] * 100.0 / max(row["rows"], 1) for c in clean.columns}
    kept = [c for c in clean.columns if missing_pct[c] <= rule.drop_above * 100]
    numeric = [c for c in all_numeric if c in kept]
    mean = {c: row[f"m_{c}"] for c in numeric}
    std = {c: row[f"s_{c}"] for c in numeric}
    strategies = {
        c: strategy_for(c, c in numeric, missing_pct[c], rule) for c in kept if missing[c] > 0
    }
    for c, strategy in strategies.items():
        if strategy in ("knn", "iterative") and (c not in numeric or len(numeric) < 2):
            strategies[c] = "median" if c in numeric else "most_frequent"
    by_text = [c for c in kept if c not in numeric]
    by_mode = [c for c in numeric if strategies.get(c) == "most_frequent"]

    median, mode = {}, {}
    if numeric:
        brackets = {c: row[f"b_{c}"] for c in numeric}
        medians = exact_medians(clean, numeric, brackets=brackets)
        median = {r.feature: r["median"] for r in medians.collect()}
    if by_text:
        mode.update({r.feature: r["mode"] for r in modes(clean, by_text, "string").collect()})
    if by_mode:
        mode.update({r.feature: str(r["mode"]) for r in modes(clean, by_mode, "double").collect()})

    fits = {
        c: ColumnFit(
            c,
            c in all_numeric,
            missing_pct[c],
            strategies.get(c),
            c not in kept,
            mean.get(c),
            median.get(c),
            mode.get(c),
            std.get(c),
        )
        for c in clean.columns
    }
    chain = None
    if "iterative" in strategies.values():
        chain = fit_chain(clean, numeric, mean, std, rule.max_iter, rule.tol)
    donors = clean.select(*numeric) if "knn" in strategies.values() else None
    return Imputer(rule, fits, chain, donors)


def fill_from_batch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill with the batch's own medians and modes, for scoring without a fitted imputer."""
    columns = list(columns or df.columns)
    numeric = [c for c in numeric_columns(df) if c in columns]
    texts = [c for c in columns if c not in numeric]
    fills = {}
    if numeric:
        median = {r.feature: r["median"] for r in exact_medians(df, numeric).collect()}
        for c in numeric:
            if median.get(c) is not None:
                fills[c] = F.coalesce(known(df, c).cast("double"), F.lit(median[c]))
    if texts:
        mode = {r.feature: r["mode"] for r in modes(df, texts, "string").collect()}
        for c in texts:
            fills[c] = F.coalesce(F.col(c), F.lit(mode.get(c) or "Unknown"))
    return df.withColumns(fills)
