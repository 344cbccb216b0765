"""Bronze -> silver -> gold, one job per table for all snapshots asked for.

Every stage takes the months it is to rebuild. It reads and writes only their partitions; a month
that yields no rows is cleared. Without months a stage rebuilds all snapshots it finds.

Every month of a table is noted with what it was made from: the checksum of its raw rows, or the versions of
its inputs' months, and the rule. With ``only_changed`` a stage builds the months for which that is not as noted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clean, features, labels
from tidemark.operators.calendar import first_of_month_spine
from tidemark.operators.profile import require_unique_keys
from tidemark.plans import dictionary
from tidemark.session import apply_settings
from tidemark.settings import KEYS, LabelRule
from tidemark.sources import commits, schemas
from tidemark.sources.readers import NoData, read_csv, read_if_present, read_table
from tidemark.sources.writers import write_snapshots

Months = Sequence[date] | None


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return first_of_month_spine(bounds)


def months_between(spark: SparkSession, start: str, end: str) -> list[date]:
    """The spine's months, twelve a year, as literals that prune partitions."""
    return [r.snapshot_date for r in month_spine(spark, start, end).collect()]


def _of(df: DataFrame, months: Months) -> DataFrame:
    return df if months is None else df.where(F.col("snapshot_date").isin(list(months)))


def _made_from(spark: SparkSession, inputs: dict[str, str], months: Months, rule: str = "") -> dict[str, dict]:
    """What each month of a table would be made from: the versions of that month in every input."""
    held = {name: commits.versions(commits.newest(spark, path)) for name, path in inputs.items()}
    wanted = sorted(set().union(*held.values())) if months is None else [str(m) for m in months]
    return {m: {"rule": rule, **{name: of.get(m, []) for name, of in held.items()}} for m in wanted}


def _changed(spark: SparkSession, path: str, made: dict[str, dict]) -> dict[str, dict]:
    """Those months that the table was not made from the same before."""
    old = commits.newest(spark, path)
    noted = old.notes.get(MADE_FROM, {}) if old else {}
    return {m: of for m, of in made.items() if noted.get(m) != of}


MADE_FROM = "made_from"


def _dates(months: dict[str, dict]) -> list[date]:
    return [date.fromisoformat(m) for m in months if m != commits.NO_DATE]


def _stage(spark, path: str, inputs: dict[str, str], months: Months, only_changed: bool, build, rule: str = "", by_month: bool = False) -> None:
    """Build the months of a table, or those that changed, by ``build(months)``."""
    made = _made_from(spark, inputs, months, rule)
    if only_changed:
        made = _changed(spark, path, made)
        if not made:
            return
        months = _dates(made)
    write_snapshots(build(months), path, months=months, notes={MADE_FROM: made}, by_month=by_month)


def bronze(
    spark: SparkSession, sources: dict[str, str], root: str, start: str, end: str, only_changed: bool = False
) -> None:
    """Land the raw rows of every month of the spine, as text, one partition per month."""
    spine = months_between(spark, start, end)
    for entity, path in sources.items():
        raw = read_csv(spark, path, schemas.RAW[entity])
        dated = _of(raw.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date")), spine)
        target, months = f"{root}/bronze/{entity}", spine
        found = commits.month_fingerprints(dated)
        made = {str(m): {"rows": found.get(str(m), "")} for m in months}
        if only_changed:
            made = _changed(spark, target, made)
            if not made:
                continue
            months = _dates(made)
        write_snapshots(_of(dated, months), target, "csv", months=months, notes={MADE_FROM: made})


def read_bronze(spark: SparkSession, root: str, entity: str, months: Months = None) -> DataFrame:
    """Landed rows as text, the date of their snapshot included."""
    names = schemas.RAW[entity].fieldNames()
    landed = _of(read_table(spark, f"{root}/bronze/{entity}"), months)
    return landed.withColumn("snapshot_date", F.col("snapshot_date").cast("string")).select(names)


def silver(
    spark: SparkSession, root: str, entities=tuple(schemas.RAW), months: Months = None, only_changed: bool = False
) -> None:
    for entity in entities:

        def build(months: Months, entity=entity) -> DataFrame:
            return clean.SILVER[entity](read_bronze(spark, root, entity, months))

        inputs = {"bronze": f"{root}/bronze/{entity}"}
        # cleaning goes row by row over files of a month each
        _stage(spark, f"{root}/silver/{entity}", inputs, months, only_changed, build, by_month=True)


def gold_labels(
    spark: SparkSession,
    root: str,
    rule: LabelRule = LabelRule(),
    by_start: bool = False,
    months: Months = None,
    only_changed: bool = False,
) -> None:
    """Label store of every snapshot; ``by_start`` counts from the loan start date."""

    def build(months: Months) -> DataFrame:
        loans = _of(read_table(spark, f"{root}/silver/loans"), months)
        if by_start:
            return labels.label_store(labels.loan_daily_by_start(loans), rule)
        return labels.labels_at(loans, rule)

    inputs = {"loans": f"{root}/silver/loans"}
    named = rule.name + (" by start" if by_start else "")
    _stage(spark, f"{root}/gold/label_store", inputs, months, only_changed, build, named)


def _silver(spark: SparkSession, root: str, entity: str, months: Months) -> DataFrame | None:
    found = read_if_present(spark, f"{root}/silver/{entity}")
    return None if found is None else _of(found, months)


def gold_features(spark: SparkSession, root: str, months: Months = None, only_changed: bool = False) -> None:
    """Feature store of every snapshot: financials decide the rows, attributes are optional.

    Raises ``NoData`` without financials, and ``DuplicateKeys`` where a joined table repeats a key.
    """

    def build(months: Months) -> DataFrame:
        financials, attributes = (_silver(spark, root, e, months) for e in ("financials", "attributes"))
        if financials is None:
            raise NoData(f"no financials in {root}/silver")
        for table in filter(None, (financials, attributes)):
            require_unique_keys(table, KEYS)
        return features.feature_store(financials, attributes)

    inputs = {e: f"{root}/silver/{e}" for e in ("financials", "attributes")}
    _stage(spark, f"{root}/gold/feature_store", inputs, months, only_changed, build)


def gold_customers(spark: SparkSession, root: str, months: Months = None, only_changed: bool = False) -> None:
    """Wide customer table of every snapshot, led by the clickstream.

    Occupations have the codes of the dictionary in ``gold/occupation_codes``, so that a month that is built
    again, or later than the others, is coded like them.

    Raises ``NoData`` without clickstream, and ``DuplicateKeys`` where a joined table repeats a key.
    """

    def codes(rows: DataFrame) -> DataFrame:
        return dictionary.with_values_of(rows, f"{root}/gold/occupation_codes", "Occupation", "Occupation_code")

    def build(months: Months) -> DataFrame:
        clickstream, attributes, financials = (
            _silver(spark, root, e, months) for e in ("clickstream", "attributes", "financials")
        )
        if clickstream is None:
            raise NoData(f"no clickstream in {root}/silver")
        joined = [t for t in (attributes, financials) if t is not None]
        for table in joined:
            require_unique_keys(table, KEYS)
        return features.customer_table(clickstream, joined, codes)

    inputs = {e: f"{root}/silver/{e}" for e in ("clickstream", "attributes", "financials")}
    _stage(spark, f"{root}/gold/customers", inputs, months, only_changed, build)


def backfill(
    spark: SparkSession,
    sources: dict[str, str],
    root: str,
    start: str,
    end: str,
    rule: LabelRule = LabelRule(),
    only_changed: bool = False,
) -> None:
    """All layers for every month from ``start`` to ``end``; rerunning replaces those months only.

    A gold table is built if the source that leads it is given. With ``only_changed`` a month is built again only
    in the tables whose inputs for it, or whose rule, are not what it was built from.
    """
    apply_settings(spark)
    months = months_between(spark, start, end)
    bronze(spark, sources, root, start, end, only_changed)
    silver(spark, root, tuple(sources), months, only_changed)
    if "loans" in sources:
        gold_labels(spark, root, rule, months=months, only_changed=only_changed)
    if "financials" in sources:
        gold_features(spark, root, months, only_changed)
    if "clickstream" in sources:
        gold_customers(spark, root, months, only_changed)
