"""Scans and sinks, on data written from the given tables first."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.catalog.drift import flat_summary, summary_sql
from tidemark.catalog.features import GOLD_SQL
from tidemark.operators import clean, drift, features, metrics, models, profile
from tidemark.plans import datamart, dictionary, monitoring
from tidemark.session import shared_folder
from tidemark.settings import LabelRule
from tidemark.sources import bucketed, commits, readers, schemas, writers
from tidemark.sources import surrogates as S
from tidemark.streaming import once, snapshots


def _folder(spark):
    """A new folder in the shared location."""
    return f"{shared_folder(spark)}/tidemark/{spark.sql('SELECT uuid()').first()[0]}"


def _attributes_csv(spark, sf_dir):
    path = f"{_folder(spark)}/attributes"
    rows = S.attributes(spark, sf_dir)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("src_csv", f"WITH {V.ATTRIBUTES} SELECT Customer_ID, Name, Age, SSN, Occupation, cast(snapshot_date as varchar) AS snapshot_date FROM attributes")
def csv_scan(spark, sf_dir):
    """Everything as text, embedded quotes intact."""
    return readers.read_csv(spark, _attributes_csv(spark, sf_dir), schemas.ATTRIBUTES)


_STORE = "SELECT Customer_ID, Age, Occupation, snapshot_date FROM silver_att"


def _silver_table(spark, sf_dir):
    path = f"{_folder(spark)}/silver_attributes"
    silver = clean.silver_attributes(S.attributes(spark, sf_dir))
    writers.write_snapshots(silver.select("Customer_ID", "Age", "Occupation", "snapshot_date"), path)
    return path


@query("src_snapshot", f"WITH {V.SILVER_ATTRIBUTES} {_STORE} WHERE snapshot_date = DATE '2024-03-01'")
def snapshot_scan(spark, sf_dir):
    return readers.read_table(spark, _silver_table(spark, sf_dir), "2024-03-01")


@query("src_all_snapshots", f"WITH {V.SILVER_ATTRIBUTES} {_STORE}")
def all_snapshots(spark, sf_dir):
    return readers.read_table(spark, _silver_table(spark, sf_dir))


@query("src_optional", f"WITH {V.SILVER_ATTRIBUTES} {_STORE}")
def optional_scan(spark, sf_dir):
    """One source that exists and one that does not."""
    path = _silver_table(spark, sf_dir)
    present = readers.read_first_present(
        [readers.read_if_present(spark, f"{path}_absent"), readers.read_if_present(spark, path)]
    )
    return present[0]


@query("src_any_format", f"WITH {V.SCORES} SELECT 'parquet' AS format, * FROM scores UNION ALL SELECT 'jsonl', * FROM scores UNION ALL SELECT 'csv', * FROM scores")
def any_format(spark, sf_dir):
    """The same rows through three formats picked by extension."""
    folder = _folder(spark)
    scores = S.scores(spark, sf_dir)
    whole = None
    for fmt, extension in [("parquet", "parquet"), ("json", "jsonl"), ("csv", "csv")]:
        path = f"{folder}/scores.{extension}"
        scores.write.format(fmt).option("header", True).save(path)
        back = readers.read_any(spark, path).select(
            F.lit(extension).alias("format"),
            *[F.col(c).cast(t).alias(c) for c, t in scores.dtypes],
        )
        whole = back if whole is None else whole.unionByName(back)
    return whole


@query(
    "src_json_records",
    f"""WITH {V.SCORES} SELECT Customer_ID, label, score, cast(label as varchar) || ';' || cast(label + 1 as varchar) AS steps,
 CASE WHEN label = 1 THEN dataset END AS note FROM scores""",
)
def json_records(spark, sf_dir):
    """Pretty-printed nested objects with commas between them, under a ``.csv`` name."""
    path = f"{_folder(spark)}/scores.csv"
    steps = F.array(*[F.struct((F.col("label") + k).alias("x")) for k in (0, 1)]).alias("steps")
    note = F.struct(F.when(F.col("label") == 1, F.col("dataset")).alias("text")).alias("note")
    scores = S.scores(spark, sf_dir).select("Customer_ID", "label", "score", steps, note)
    pretty = F.concat(F.to_json(F.struct("*"), {"pretty": "true"}), F.lit(","))
    scores.select(pretty.alias("value")).write.text(path)
    schema = "Customer_ID bigint, label int, score double, steps array<struct<x:int>>, note struct<text:string>"
    return readers.read_json_records(spark, path, schema).select(
        "Customer_ID", "label", "score", F.concat_ws(";", F.col("steps.x").cast("array<string>")).alias("steps"),
        F.col("note.text").alias("note"),
    )


@query(
    "src_json_mixed",
    f"""WITH {V.SCORES} SELECT Customer_ID, label, score, dataset, 'it''s {{"' || dataset || '"}} }}' AS quoted, cast(Customer_ID % 4 as integer) AS layout FROM scores
 UNION ALL SELECT Customer_ID, label, score, dataset, NULL, 4 FROM scores WHERE Customer_ID % 7 = 0""",
)
def json_mixed(spark, sf_dir):
    """A folder whose files hold lines, spread records, records with commas and arrays, mixed, with braces in strings."""
    path = f"{_folder(spark)}/mixed.json"
    layout = F.col("Customer_ID") % 4
    quoted = F.concat(F.lit('it\'s {"'), F.col("dataset"), F.lit('"} }'))
    scores = S.scores(spark, sf_dir).select(
        "Customer_ID", "label", "score", "dataset", quoted.alias("quoted"), layout.cast("int").alias("layout")
    )
    line, spread = F.to_json(F.struct("*")), F.to_json(F.struct("*"), {"pretty": "true"})
    text = F.when(F.col("layout") == 0, line).when(F.col("layout") == 1, spread).otherwise(F.concat(spread, F.lit(",")))
    scores.where("layout < 3").select(text.alias("value")).write.text(path)
    groups = scores.where("layout = 3").groupBy(F.floor(F.col("Customer_ID") / 40)).agg(F.collect_list(F.struct("*")).alias("all"))
    groups.select(F.to_json("all", {"pretty": "true"}).alias("value")).write.mode("append").text(path)
    # one line per file: arrays of records without any line end
    again = scores.where("Customer_ID % 7 = 0").drop("quoted").withColumn("layout", F.lit(4))
    whole = again.groupBy(F.floor(F.col("Customer_ID") / 70).alias("g")).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    whole.select("value").write.mode("append").option("lineSep", " ").text(path)
    schema = "Customer_ID bigint, label int, score double, dataset string, quoted string, layout int"
    return readers.read_json_records(spark, path, schema)


@query("src_scoring_input", f"WITH {V.CLICKSTREAM} SELECT * FROM clickstream")
def scoring_input(spark, sf_dir):
    path = f"{_folder(spark)}/clicks.parquet"
    S.clickstream(spark, sf_dir).write.parquet(path)
    return readers.read_scoring_input(spark, path)


@query(
    "snk_idempotent_snapshots",
    f"WITH {V.SILVER_ATTRIBUTES} SELECT snapshot_date, count(*) AS row_count FROM silver_att GROUP BY snapshot_date",
)
def idempotent_snapshots(spark, sf_dir):
    """All snapshots written, then one of them again: counts stay the same."""
    path = _silver_table(spark, sf_dir)
    once_more = clean.silver_attributes(S.attributes(spark, sf_dir)).where(
        "snapshot_date = '2024-03-01'"
    )
    writers.write_snapshots(
        once_more.select("Customer_ID", "Age", "Occupation", "snapshot_date"), path
    )
    return profile.rows_by_snapshot(readers.read_table(spark, path))


@query(
    "snk_rerun_empties_month",
    f"""WITH {V.SILVER_ATTRIBUTES} {_STORE} WHERE snapshot_date NOT IN (DATE '2024-03-01', DATE '2024-04-01')
 OR (snapshot_date = DATE '2024-04-01' AND Age IS NOT NULL)""",
)
def rerun_empties_month(spark, sf_dir):
    """Two months rebuilt under a rule that leaves nothing of one: its old rows go."""
    path = _silver_table(spark, sf_dir)
    months = ["2024-03-01", "2024-04-01"]
    again = clean.silver_attributes(S.attributes(spark, sf_dir)).where(
        "snapshot_date = '2024-04-01' AND Age IS NOT NULL"
    )
    writers.write_snapshots(
        again.select("Customer_ID", "Age", "Occupation", "snapshot_date"), path, months=months
    )
    return readers.read_table(spark, path)


@query(
    "snk_unpublished_run",
    f"""WITH {V.SILVER_ATTRIBUTES} {_STORE} WHERE snapshot_date <> DATE '2024-04-01' OR Age IS NOT NULL""",
)
def unpublished_run(spark, sf_dir):
    """A run over all months that dies before it publishes changes nothing; the one month run after it does."""
    path = _silver_table(spark, sf_dir)
    rows = readers.read_table(spark, path)
    commits.write_version(rows.withColumn("Age", F.lit(-1)), path)  # all files are there, no manifest names them
    again = rows.where("snapshot_date = '2024-04-01' AND Age IS NOT NULL")
    writers.write_snapshots(again, path, months=["2024-04-01"])
    return readers.read_table(spark, path)


@query(
    "snk_batch_once",
    f"""WITH {V.DECIDED} SELECT Customer_ID, label, score, dataset, prediction FROM decided
 UNION ALL SELECT Customer_ID, label, score, dataset, prediction FROM decided WHERE dataset = 'OOT1' AND prediction = 1""",
)
def batch_once(spark, sf_dir):
    """A scored batch that is sent again, at another time and in another order, lands once; another batch adds to it."""
    path = f"{_folder(spark)}/predictions_monitoring"
    decided = metrics.decide(S.scores(spark, sf_dir)).withColumn("timestamp", F.current_timestamp())
    other = decided.where("dataset = 'OOT1' AND prediction = 1")
    for batch in (decided, decided.orderBy(F.desc("Customer_ID")), other, decided.repartition(3)):
        writers.copy_for_monitoring(batch, path)
    return readers.read_table(spark, path).select("Customer_ID", "label", "score", "dataset", "prediction")


@query("snk_bronze", f"WITH {V.ATTRIBUTES} SELECT Customer_ID, Name, Age, SSN, Occupation, cast(snapshot_date as varchar) AS snapshot_date FROM attributes")
def bronze_table(spark, sf_dir):
    root = _folder(spark)
    datamart.bronze(
        spark, {"attributes": _attributes_csv(spark, sf_dir)}, root, "2023-01-01", "2024-12-01"
    )
    return datamart.read_bronze(spark, root, "attributes")


_PANELS = {
    "loans": S.loans,
    "attributes": S.attributes,
    "financials": S.financials,
    "clickstream": S.customer_clicks,
}


def _land(spark, sf_dir, folder, *entities):
    """Raw CSV files with every declared column, the way the sources deliver them."""
    paths = {}
    for entity in entities:
        df = _PANELS[entity](spark, sf_dir)
        columns = schemas.RAW[entity].fieldNames()
        full = df.select(
            *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
        )
        paths[entity] = f"{folder}/raw/{entity}"
        full.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(paths[entity])
    return paths


@query("dmt_gold_features", GOLD_SQL)
def gold_features(spark, sf_dir):
    """Raw files through bronze, silver and gold for 24 months, read back."""
    folder = _folder(spark)
    paths = _land(spark, sf_dir, folder, "attributes", "financials")
    datamart.backfill(spark, paths, folder, "2023-01-01", "2024-12-01")
    store = readers.read_table(spark, f"{folder}/gold/feature_store")
    return store.withColumns(
        {c: F.round(c, 6) for c in ["Debt_to_Income_Ratio", "EMI_Burden_Ratio"]}
    )


@query(
    "dmt_gold_labels",
    f"""WITH {V.PANEL} SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
 FROM panel WHERE mob = 6""",
)
def gold_labels(spark, sf_dir):
    """Raw loans of every month through bronze, silver and gold, read back."""
    folder = _folder(spark)
    paths = _land(spark, sf_dir, folder, "loans")
    datamart.backfill(spark, paths, folder, "1990-01-01", "2010-12-01")
    return readers.read_table(spark, f"{folder}/gold/label_store")


@query(
    "dmt_customers",
    f"""WITH {V.CUSTOMER_CLICKS}, {V.SILVER_ATTRIBUTES}, {V.SILVER_FINANCIALS},
 w AS (SELECT c.Customer_ID, c.snapshot_date, cast(fe_1 as double) AS fe_1, cast(fe_2 as double) AS fe_2, cast(fe_1 + fe_2 + fe_3 as double) AS fe_sum,
  coalesce(Age, 0) AS Age, coalesce(Occupation, 'Unknown') AS Occupation, coalesce(Annual_Income, 0) AS Annual_Income
  FROM clicks c LEFT JOIN silver_att USING (Customer_ID, snapshot_date) LEFT JOIN silver_fin USING (Customer_ID, snapshot_date))
 SELECT *, cast(dense_rank() OVER (ORDER BY Occupation) - 1 as integer) AS Occupation_code FROM w""",
)
def customers(spark, sf_dir):
    """The wide table led by the clickstream, through all layers."""
    folder = _folder(spark)
    paths = _land(spark, sf_dir, folder, "clickstream", "attributes", "financials")
    datamart.backfill(spark, paths, folder, "2023-01-01", "2024-12-01")
    return readers.read_table(spark, f"{folder}/gold/customers").select(
        "Customer_ID", "snapshot_date", "fe_1", "fe_2", "fe_sum", "Age", "Occupation", "Annual_Income", "Occupation_code"
    )


_LATE = "CASE WHEN snapshot_date = DATE '2024-12-01' AND Occupation <> 'NA' THEN 'Aardvark_keeper' WHEN Occupation = 'NA' THEN 'ZZ' ELSE Occupation END"


@query(
    "dmt_customers_rerun",
    f"""WITH {V.CUSTOMER_CLICKS}, {V.SILVER_ATTRIBUTES},
 w AS (SELECT c.Customer_ID, c.snapshot_date, coalesce({_LATE}, 'Unknown') AS Occupation
  FROM clicks c LEFT JOIN silver_att USING (Customer_ID, snapshot_date)),
 seen AS (SELECT Occupation, min(CASE WHEN snapshot_date < DATE '2024-12-01' THEN 0 ELSE 1 END) AS run, min(snapshot_date) AS first_seen FROM w GROUP BY Occupation),
 codes AS (SELECT Occupation, first_seen, cast(row_number() OVER (ORDER BY run, Occupation) - 1 as integer) AS code FROM seen)
 SELECT 'row' AS kind, Customer_ID, snapshot_date, Occupation, code AS Occupation_code FROM w JOIN codes USING (Occupation)
 UNION ALL SELECT 'dictionary', NULL, first_seen, Occupation, code FROM codes""",
)
def customers_rerun(spark, sf_dir):
    """Months up to November, then a late December that brings a new occupation, then one old month again.

    The new occupation sorts before all others, but takes the next code; no old code changes.
    """
    folder = _folder(spark)
    paths = _land(spark, sf_dir, folder, "clickstream")
    raw = S.attributes(spark, sf_dir)
    unfit = ~F.col("Occupation").rlike("^[a-zA-Z_]+$")
    late = F.when((F.col("snapshot_date") == "2024-12-01") & ~unfit, "Aardvark_keeper")
    changed = raw.withColumn("Occupation", late.when(unfit, "ZZ").otherwise(F.col("Occupation")))
    paths["attributes"] = f"{folder}/raw/attributes"
    changed.write.option("header", True).option("escape", '"').csv(paths["attributes"])
    for start, end in (("2023-01-01", "2024-11-01"), ("2024-12-01", "2024-12-01"), ("2023-05-01", "2023-05-01")):
        datamart.backfill(spark, paths, folder, start, end)
    rows = readers.read_table(spark, f"{folder}/gold/customers").select(
        F.lit("row").alias("kind"), "Customer_ID", "snapshot_date", "Occupation", "Occupation_code"
    )
    codes = dictionary.stored(spark, f"{folder}/gold/occupation_codes", "Occupation", "Occupation_code")
    return rows.unionByName(codes.withColumn("kind", F.lit("dictionary")), allowMissingColumns=True)


@query(
    "dmt_one_month_rerun",
    f"""WITH {V.PANEL} SELECT loan_id, Customer_ID, label, label_def, snapshot_date FROM (
 SELECT *, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def FROM panel WHERE mob = 6 AND snapshot_date <> DATE '1997-05-01'
 UNION ALL SELECT *, CASE WHEN dpd >= 60 THEN 1 ELSE 0 END, '60dpd_3mob' FROM panel WHERE mob = 3 AND snapshot_date = DATE '1997-05-01')""",
)
def one_month_rerun(spark, sf_dir):
    """A whole backfill, then one month again under another label rule: only that month changes."""
    folder = _folder(spark)
    paths = _land(spark, sf_dir, folder, "loans")
    datamart.backfill(spark, paths, folder, "1990-01-01", "2010-12-01")
    datamart.backfill(spark, paths, folder, "1997-05-01", "1997-05-01", LabelRule(dpd=60, mob=3))
    return readers.read_table(spark, f"{folder}/gold/label_store")


_MART = ("bronze/attributes", "bronze/financials", "silver/attributes", "silver/financials", "gold/feature_store")


@query(
    "dmt_only_changed_months",
    f"""WITH {V.FINANCIALS}, m AS (SELECT DISTINCT snapshot_date FROM financials),
 t AS (SELECT unnest(['{"', '".join(_MART)}']) AS place),
 r AS (SELECT unnest([1, 2, 3]) AS run)
 SELECT run, place, cast(snapshot_date as varchar) AS snapshot_date, run = 1 OR (run = 3 AND snapshot_date = DATE '2023-05-01'
  AND place IN ('bronze/financials', 'silver/financials', 'gold/feature_store')) AS rewritten FROM m, t, r""",
)
def only_changed_months(spark, sf_dir):
    """Three backfills: all, the same again, and one with a changed raw month. Which months did each write?"""
    folder = _folder(spark)
    paths = _land(spark, sf_dir, folder, "attributes", "financials")
    before, rows = {}, []
    for run in (1, 2, 3):
        if run == 3:
            raw = spark.read.schema(schemas.RAW["financials"]).option("header", True).option("escape", '"').csv(paths["financials"])
            paths["financials"] = f"{folder}/raw/financials_again"
            income = F.when(F.col("snapshot_date") == "2023-05-01", "1").otherwise(F.col("Annual_Income"))
            changed = raw.withColumn("Annual_Income", income).repartition(5)
            changed.write.option("header", True).option("escape", '"').csv(paths["financials"])
        datamart.backfill(spark, paths, folder, "2023-01-01", "2024-12-01", only_changed=True)
        for place in _MART:
            now = commits.versions(commits.newest(spark, f"{folder}/{place}"))
            rows += [(run, place, month, v != before.get((place, month))) for month, v in now.items()]
            before |= {(place, month): v for month, v in now.items()}
    return spark.createDataFrame(rows, "run int, place string, snapshot_date string, rewritten boolean")


@query("snk_compact", "SELECT o_orderkey, o_custkey FROM orders")
def compact(spark, sf_dir):
    path = f"{_folder(spark)}/orders"
    writers.write_compact(S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), path)
    return spark.read.parquet(path)


@query("snk_predictions", f"WITH {V.DECIDED} SELECT Customer_ID, label, score, dataset, prediction FROM decided")
def predictions(spark, sf_dir):
    path = f"{_folder(spark)}/predictions.json"
    decided = metrics.decide(S.scores(spark, sf_dir))
    writers.write_predictions(decided, path)
    return spark.read.schema(decided.schema).json(path)


@query("snk_monitoring_copy", f"WITH {V.DECIDED} SELECT dataset, count(*) AS rows FROM decided GROUP BY dataset")
def monitoring_copy(spark, sf_dir):
    path = f"{_folder(spark)}/predictions_monitoring"
    decided = metrics.decide(S.scores(spark, sf_dir)).withColumn("timestamp", F.current_timestamp())
    writers.write_scored(decided, f"{path}_scored.parquet", path)
    return readers.read_table(spark, path).groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))


@query("snk_monitoring_summary", summary_sql(["ts", "user_id", "value"], ["value", "user_id"]))
def monitoring_summary(spark, sf_dir):
    """The summary document written as JSON and read back, flattened."""
    path = f"{_folder(spark)}/monitoring"
    events = S.table(spark, sf_dir, "events").select("ts", "value", "user_id")
    summary = drift.monitoring_summary(
        events.where("ts < '2024-01-16'"), events.where("ts >= '2024-01-16'"), source="events"
    )
    writers.write_monitoring_summary(summary, path)
    return flat_summary(spark.read.schema(summary.schema).json(path))


@query("mon_job", summary_sql(["event_type", "ts", "user_id", "value"], ["value", "user_id"], error="ERROR"))
def monitoring_job(spark, sf_dir):
    """The job on files: a run over two halves, and one whose input is missing."""
    folder = _folder(spark)
    events = S.table(spark, sf_dir, "events").select("ts", "value", "user_id", "event_type")
    events.where("ts < '2024-01-16'").write.parquet(f"{folder}/reference.parquet")
    events.where("ts >= '2024-01-16'").write.parquet(f"{folder}/current.parquet")
    ran = monitoring.monitor(spark, f"{folder}/reference.parquet", f"{folder}/current.parquet", f"{folder}/out")
    failed = monitoring.monitor(spark, f"{folder}/reference.parquet", f"{folder}/absent.parquet", f"{folder}/out")
    written = spark.read.schema(ran.schema).json(f"{folder}/out")
    return flat_summary(written.where("status <> 'ERROR'")).withColumn("failed_run", failed.select("status").scalar())


@query(
    "mon_compare_datasets",
    f"""WITH {V.DECIDED} SELECT dataset, count(*) AS sample_size,
 round(count(*) FILTER (label = prediction)::double/count(*), 6) AS accuracy FROM decided WHERE dataset <> 'OOT2' GROUP BY dataset""",
)
def compare_datasets(spark, sf_dir):
    """Labels and predictions from files, per dataset; one dataset has no predictions and is left out."""
    folder = _folder(spark)
    decided = metrics.decide(S.scores(spark, sf_dir)).withColumnRenamed("score", "confidence")
    datasets = {}
    for name in ("Training", "OOT1", "OOT2"):
        rows = decided.where(F.col("dataset") == name)
        datasets[name] = f"{folder}/{name}/labels.parquet", f"{folder}/{name}/predictions.parquet"
        rows.select("Customer_ID", "label").write.parquet(datasets[name][0])
        if name != "OOT2":
            rows.select("Customer_ID", "prediction", "confidence").write.parquet(datasets[name][1])
    out = monitoring.compare_datasets(spark, datasets)
    return out.select("dataset", "sample_size", F.round("accuracy", 6).alias("accuracy"))


@query(
    "snk_registry",
    f"""WITH {V.DECIDED} SELECT dataset AS model, 'sample_size' AS metric, count(*)::double AS value FROM decided GROUP BY dataset
 UNION ALL SELECT dataset, 'accuracy', round(count(*) FILTER (label = prediction)::double/count(*), 6) FROM decided GROUP BY dataset
 UNION ALL SELECT 'best by size', any_value(b), max(n)::double FROM (
  SELECT first(dataset ORDER BY n DESC, place) AS b, max(n) AS n FROM (SELECT dataset, count(*) AS n,
   CASE dataset WHEN 'Training' THEN 0 WHEN 'OOT1' THEN 1 ELSE 2 END AS place FROM decided GROUP BY dataset))""",
)
def registry_sink(spark, sf_dir):
    """A comparison written as a registry, metrics and best row read back."""
    path = f"{_folder(spark)}/registry"
    rated = metrics.evaluate(metrics.decide(S.scores(spark, sf_dir))).withColumnRenamed("dataset", "model")
    place = F.when(F.col("model") == "Training", 0).when(F.col("model") == "OOT1", 1).otherwise(2)
    comparison = rated.select("model", place.alias("place"), F.lit(0.7).alias("threshold"), "accuracy", "sample_size")
    writers.write_registry(models.registry(comparison), models.best_model(comparison, "sample_size"), path)
    rows = spark.read.parquet(f"{path}/metrics").where("metric <> 'threshold'")
    best = spark.read.json(f"{path}/best_model").select(
        F.lit("best by size").alias("model"), F.col("best_model").alias("metric"), F.col("best_score").cast("double").alias("value")
    )
    return rows.unionByName(best).withColumn("value", F.round("value", 6))


@query("str_clean_arrivals", f"WITH {V.SILVER_ATTRIBUTES} SELECT * FROM silver_att")
def clean_arrivals(spark, sf_dir):
    """Raw files picked up by a file stream in two runs; the second adds to the same months."""
    folder = _folder(spark)
    raw = S.attributes(spark, sf_dir)
    late = F.pmod(F.hash("Customer_ID"), F.lit(2)) == 1
    for part in (raw.where(~late), raw.where(late)):
        part.write.mode("append").option("header", True).option("escape", '"').csv(f"{folder}/raw")
        snapshots.clean_arrivals(
            spark, "attributes", f"{folder}/raw", f"{folder}/silver", f"{folder}/progress"
        ).awaitTermination()
    return snapshots.read_arrivals(spark, f"{folder}/silver")



@query(
    "str_events_once",
    """WITH e AS (SELECT event_id, ts, event_type, ts >= TIMESTAMP '2024-01-20' AS new FROM events),
 mark AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM e WHERE NOT new AND event_id % 10 <> 3)
 SELECT 'landed' AS place, event_id, ts, event_type FROM e WHERE new OR event_id % 10 <> 3
  OR ts >= (SELECT mark FROM mark)
 UNION ALL SELECT 'late', event_id, ts, event_type FROM e WHERE NOT new AND event_id % 10 IN (3, 4)
  AND ts < (SELECT mark FROM mark)""",
)
def events_once(spark, sf_dir):
    """Files in two runs: the second brings new events, resends old ones, and has some that come too late.

    Every event lands once; what is behind the watermark, resent or not, goes to the late table.
    """
    folder = _folder(spark)
    events = S.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    new, part = F.col("ts") >= "2024-01-20", F.col("event_id") % 10
    first = events.where(~new & (part != 3))
    for batch in (first, events.where(new | part.isin(3, 4)).unionByName(events.where(new & (part == 7)))):
        batch.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        once.land_once(
            stream, f"{folder}/landed", f"{folder}/late", ["event_id"], "ts", "2 days", f"{folder}/progress"
        ).awaitTermination()
    landed, late = (readers.read_table(spark, f"{folder}/{p}") for p in ("landed", "late"))
    tagged = landed.withColumn("place", F.lit("landed")).unionByName(late.withColumn("place", F.lit("late")))
    return tagged.select("place", "event_id", "ts", "event_type")


@query("jon_bucketed_features", GOLD_SQL)
def bucketed_features(spark, sf_dir):
    """The gold join over silver tables stored by key: no shuffle under it."""
    folder = _folder(spark)
    tag = folder.rsplit("/", 1)[1].replace("-", "")
    tables = {f"silver_fin_{tag}": clean.silver_financials, f"silver_att_{tag}": clean.silver_attributes}
    for (name, silver), raw in zip(tables.items(), (S.financials, S.attributes)):
        bucketed.store(silver(raw(spark, sf_dir)), name, f"{folder}/{name}", buckets=8)
    store = features.choose_features(bucketed.join(spark, list(tables)))
    return store.withColumns({c: F.round(c, 6) for c in ["Debt_to_Income_Ratio", "EMI_Burden_Ratio"]})
