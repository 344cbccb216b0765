"""The registered queries of the operators, one each, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    classifier,
    licenses,
    mixing,
    neighbours,
    packing,
    periodic,
    quality_rules,
    simhash,
    token_files,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_token_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


@query("op1_quality_rules", quality_rules.SQL)
def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


@query("op7_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_url_filter")
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op9_nearest_neighbours", neighbours.SQL)
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_warc")
def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op2_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weighted(table(spark, sf_dir, "documents"))


@query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(table(spark, sf_dir, "documents"))


@query("op12_vector_codes", vector_codes.SQL)
def vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query("op13_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
