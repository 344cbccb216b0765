"""Credit-panel views over the TPC-H-like test tables, dirt injected by key arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.split import integer_hash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer(key) -> F.Column:
    return F.concat(F.lit("CUS_"), key.cast("string"))


def loans(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Loan panel; ``start`` and ``end`` are first days of months that bound the scan."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if start and end:
        after = F.add_months(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
        lineitem = lineitem.where(
            (F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz")) & (F.col("l_shipdate") < after)
        )
    c = F.col
    overdue = F.when(
        c("l_returnflag") == "R", F.round(c("l_extendedprice") * (c("l_partkey") % 4), 2)
    ).otherwise(F.lit(0.0))
    joined = lineitem.join(orders, c("l_orderkey") == c("o_orderkey"))
    snapshot = F.trunc("l_shipdate", "MM")
    return joined.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("loan_id"),
        _customer(c("o_custkey")).alias("Customer_ID"),
        snapshot.alias("snapshot_date"),
        F.add_months(snapshot, -c("l_linenumber")).alias("loan_start_date"),
        c("l_linenumber").alias("installment_num"),
        F.lit(10).alias("tenure"),
        c("l_extendedprice").cast("decimal(18,2)").alias("due_amt"),
        overdue.cast("decimal(18,2)").alias("overdue_amt"),
    )


def _customer_snapshot(key: str = "c_custkey"):
    return F.make_date(
        F.when(F.col(key) % 24 >= 12, 2024).otherwise(2023),
        (F.col(key) % 12 + 1).cast("int"),
        F.lit(1),
    ).alias("snapshot_date")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    age = (k % 60 + 18).cast("string")
    return table(spark, sf_dir, "customer").select(
        _customer(k).alias("Customer_ID"),
        F.concat("c_name", F.when(k % 7 == 0, '"r').otherwise("")).alias("Name"),
        F.when(k % 17 == 0, "-500")
        .when(k % 13 == 0, F.concat(age, F.lit("_")))
        .when(k % 29 == 0, "4000")
        .otherwise(age)
        .alias("Age"),
        F.when(k % 19 == 0, "#F%$D@*&8")
        .otherwise(F.concat_ws("-", k % 900 + 100, k % 90 + 10, k % 9000 + 1000))
        .alias("SSN"),
        F.when(k % 16 == 0, "_______")
        .when(k % 23 == 0, "A1")
        .otherwise(F.col("c_mktsegment"))
        .alias("Occupation"),
        _customer_snapshot(),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    return table(spark, sf_dir, "customer").select(
        _customer(k).alias("Customer_ID"),
        F.concat(
            text((F.col("c_acctbal") * 10 + 20000).cast("decimal(18,2)")),
            F.when(k % 11 == 0, "_").otherwise(""),
        ).alias("Annual_Income"),
        text(k % 6000 + 1500).alias("Monthly_Inhand_Salary"),
        text(k % 7).alias("Num_Bank_Accounts"),
        F.when(k % 31 == 0, "-1").when(k % 37 == 0, "1500").otherwise(text(k % 9)).alias(
            "Num_Credit_Card"
        ),
        F.when(k % 14 == 0, "").otherwise(text(k % 40 - 3)).alias("Delay_from_due_date"),
        F.when(k % 10 == 0, "_").otherwise(text(k % 25 - 2)).alias("Num_of_Delayed_Payment"),
        F.concat(text(k % 50), F.lit("."), text(k % 9 + 1)).alias("Credit_Utilization_Ratio"),
        F.when(k % 5 == 0, "_")
        .when(k % 3 == 0, "Good")
        .when(k % 3 == 1, "Standard")
        .otherwise("Bad")
        .alias("Credit_Mix"),
        F.when(k % 12 == 0, "!@9#%8").otherwise("Low_spent_Small_value_payments").alias(
            "Payment_Behaviour"
        ),
        text(F.abs("c_acctbal").cast("decimal(18,2)")).alias("Outstanding_Debt"),
        F.when(k % 41 == 0, "--5").otherwise(text(k % 450)).alias("Total_EMI_per_month"),
        _customer_snapshot(),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"fe_1": "click", "fe_2": "view", "fe_3": "purchase"}
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            _customer(F.col("user_id")).alias("Customer_ID"),
            F.date_trunc("week", "ts").cast("date").alias("snapshot_date"),
        )
        .agg(*[F.count_if(F.col("event_type") == kind).alias(c) for c, kind in kinds.items()])
    )


def customer_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream counts of each user, dated like the other customer tables."""
    kinds = {"fe_1": "click", "fe_2": "view", "fe_3": "purchase"}
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == kind).alias(c) for c, kind in kinds.items()]
    )
    return counts.select(
        _customer(F.col("user_id")).alias("Customer_ID"), *kinds, _customer_snapshot("user_id")
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    place = F.col("doc_id") % 5
    return labels.join(documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("doc_id").alias("Customer_ID"),
        F.col("quality").alias("label"),
        ((F.col("n_chars") % 1000).cast("double") / 1000).alias("score"),
        F.when(place == 0, "OOT2").when(place == 1, "OOT1").otherwise("Training").alias("dataset"),
    )


def model_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with six text-derived features over 24 monthly snapshots.

    The snapshot month is hashed from the key so that the months are alike.
    """
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    text = F.col("text")
    size = F.greatest(F.length(text), F.lit(1))
    words = F.greatest(F.size(F.split(text, r"\s+")), F.lit(1))
    month = (integer_hash(F.col("doc_id")) % 24).cast("int")
    return labels.join(documents, "doc_id").select(
        F.col("doc_id").alias("Customer_ID"),
        F.add_months(F.lit("2023-01-01").cast("date"), month).alias("snapshot_date"),
        F.col("quality").alias("label"),
        F.ln(size.cast("double")).alias("fe_1"),
        (size / words).alias("fe_2"),
        (F.regexp_count(text, F.lit(r"\d")) / size).alias("fe_3"),
        (F.regexp_count(text, F.lit(r"[^\w\s]")) / size).alias("fe_4"),
        (F.size(F.array_distinct(F.split(F.lower(text), r"\s+"))) / words).alias("fe_5"),
        (F.regexp_count(text, F.lit(r"[A-Z]")) / size).alias("fe_6"),
    )
