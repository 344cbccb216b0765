"""Readers, writers, the layered backfill and the file stream."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans import datamart, monitoring
from tidemark.sources import commits, readers, schemas, writers
from tidemark.streaming import snapshots


def put(path, text):
    path.write_text(text)
    return str(path)


def test_quotes_inside_quoted_fields(spark, tmp_path):
    text = 'Customer_ID,Name,Age,SSN,Occupation,snapshot_date\nC1,"""John ODonnell""r",39_,x,Job,2023-02-01\n'
    row = readers.read_csv(spark, put(tmp_path / "a.csv", text), schemas.ATTRIBUTES).first()
    assert row["Name"] == '"John ODonnell"r' and row["Age"] == "39_"


def test_header_only_file(spark, tmp_path):
    text = ",".join(schemas.ATTRIBUTES.fieldNames()) + "\n"
    df = readers.read_csv(spark, put(tmp_path / "a.csv", text), schemas.ATTRIBUTES)
    assert df.count() == 0 and df.columns == schemas.ATTRIBUTES.fieldNames()


RECORDS = [{"a": 1, "b": "x"}, {"a": 2, "b": "y{,}"}, {"a": 3, "b": "z"}]
LAYOUTS = {
    "array": json.dumps(RECORDS, indent=2),
    "flat_array": json.dumps(RECORDS),
    "commas": ",\n".join(json.dumps(r, indent=2) for r in RECORDS),
    "lines": "\n".join(json.dumps(r) for r in RECORDS),
    "spread": "\n".join(json.dumps(r, indent=1) for r in RECORDS),
}


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_json_layouts(spark, tmp_path, layout):
    path = put(tmp_path / "records.csv", LAYOUTS[layout])
    df = readers.read_any(spark, path, schema=schemas.T.StructType.fromDDL("a int, b string"))
    assert sorted((r["a"], r["b"]) for r in df.collect()) == [(r["a"], r["b"]) for r in RECORDS]


def test_malformed_records_are_skipped(spark, tmp_path):
    path = put(tmp_path / "r.json", '{"a": 1},\n{"a": broken},\n{"a": 3}')
    df = readers.read_json_records(spark, path, "a int")
    assert sorted(r["a"] for r in df.collect()) == [1, 3]


def test_no_data(spark, tmp_path):
    assert readers.read_or_none(spark, str(tmp_path / "absent.parquet")) is None
    assert readers.read_or_none(spark, put(tmp_path / "zero.csv", "")) is None
    assert readers.read_or_none(spark, put(tmp_path / "head.csv", "a,b\n")) is None
    with pytest.raises(readers.NoData):
        readers.read_first_present([None])
    with pytest.raises(ValueError):
        readers.read_scoring_input(spark, "scores.jsonl")


def test_plain_csv_by_extension(spark, tmp_path):
    df = readers.read_any(spark, put(tmp_path / "a.csv", "a,b\n1,x\n"))
    assert df.first() == (1, "x")


def _panel(spark, days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d string").select(
        "i", F.col("d").cast("date").alias("snapshot_date")
    )


def test_rewriting_a_snapshot_replaces_only_it(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_snapshots(_panel(spark, ["2023-01-01", "2023-02-01"]), path)
    for _ in range(2):
        writers.write_snapshots(_panel(spark, ["2023-02-01", "2023-02-01"]), path)
    back = readers.read_table(spark, path)
    assert back.count() == 3
    one = readers.read_table(spark, path, "2023-02-01")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()


def test_optional_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_snapshots(_panel(spark, ["2023-01-01"]), path)
    assert readers.read_if_present(spark, path, "2023-01-01").count() == 1
    assert readers.read_if_present(spark, path, "2023-05-01") is None
    assert readers.read_if_present(spark, str(tmp_path / "no")) is None


@pytest.mark.parametrize("extension", ["csv", "json", "parquet", "unknown"])
def test_prediction_formats(spark, tmp_path, extension):
    path = str(tmp_path / f"p.{extension}")
    writers.write_predictions(spark.range(3), path)
    fmt = "csv" if extension == "unknown" else extension
    reader = spark.read.option("header", True)
    assert reader.format(fmt).load(path).count() == 3


def test_monitoring_copy_never_fails_scoring(spark):
    assert writers.copy_for_monitoring(spark.range(1), "/proc/nowhere") is False


RAW = {
    "loans": "loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date\n"
    "L1,C1,2023-01-01,10,6,1000,100.1,0,500.5,500,2023-07-01\n"
    "L2,C2,2023-01-01,10,6,1000,100,100,0,400,2023-07-01\n"
    "L3,C3,2023-02-01,10,6,1000,100,100,0,400,2023-08-01\n",
    "attributes": "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\nC1,Ann,39_,123-45-6789,Job,2023-07-01\n",
    "financials": ",".join(schemas.FINANCIALS.fieldNames())
    + "\nC1,1000_,100,3,4,5,6,x,7,8,9,10,Good,250,0.5,y,No,50,11,!@9#%8,12,2023-07-01\n",
}


def _sources(tmp_path):
    return {name: put(tmp_path / f"{name}.csv", text) for name, text in RAW.items()}


def test_backfill_is_idempotent_and_equals_its_months(spark, tmp_path):
    sources = _sources(tmp_path)
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    for _ in range(2):
        datamart.backfill(spark, sources, whole, "2023-07-01", "2023-08-01")
    labels = readers.read_table(spark, f"{whole}/gold/label_store")
    rows = {r["loan_id"]: (r["label"], r["label_def"]) for r in labels.collect()}
    assert rows == {"L1": (1, "30dpd_6mob"), "L2": (0, "30dpd_6mob"), "L3": (0, "30dpd_6mob")}
    feature = readers.read_table(spark, f"{whole}/gold/feature_store").first()
    assert feature["Debt_to_Income_Ratio"] == 0.25 and feature["Credit_Mix_encoded"] == 2
    for month in ("2023-07-01", "2023-08-01"):
        datamart.backfill(spark, sources, parts, month, month)
    again = readers.read_table(spark, f"{parts}/gold/label_store").select(labels.columns)
    assert again.exceptAll(labels).isEmpty() and again.count() == 3


def test_stream_cleans_files_as_they_arrive(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put(source / "a.csv", RAW["attributes"])
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    snapshots.clean_arrivals(spark, "attributes", str(source), out, progress).awaitTermination()
    put(source / "b.csv", RAW["attributes"].replace("39_", "41").replace("-07-", "-08-"))
    snapshots.clean_arrivals(spark, "attributes", str(source), out, progress).awaitTermination()
    rows = readers.read_table(spark, out).orderBy("snapshot_date").collect()
    assert [r["Age"] for r in rows] == [None, 41]


def test_monitoring_job(spark, tmp_path):
    path, out = str(tmp_path / "ref.parquet"), str(tmp_path / "out")
    spark.range(100).select(F.col("id").cast("double").alias("x")).write.parquet(path)
    row = monitoring.monitor(spark, path, path, out).first()
    assert row["status"] == "OK" and row["psi_drift_results"]["psi_results"]["x"]["psi"] == 0.0
    assert spark.read.json(out).first()["status"] == "OK"
    assert monitoring.monitor(spark, path, str(tmp_path / "no.csv")).first()["status"] == "ERROR"


def test_datasets_without_files_are_skipped(spark, tmp_path):
    truth = spark.createDataFrame([("C1", 1), ("C2", 0)], "Customer_ID string, label int")
    guess = spark.createDataFrame([("C1", 1, 0.9), ("C2", 0, 0.2)], "Customer_ID string, prediction int, confidence double")
    truth.write.parquet(str(tmp_path / "t.parquet"))
    guess.write.parquet(str(tmp_path / "p.parquet"))
    paths = (str(tmp_path / "t.parquet"), str(tmp_path / "p.parquet"))
    out = monitoring.compare_datasets(spark, {"Training": paths, "OOT1": (paths[0], "absent.parquet")})
    assert [(r["dataset"], r["auc"], r["f1_score"]) for r in out.collect()] == [("Training", 1.0, 1.0)]
    assert monitoring.compare_datasets(spark, {"OOT1": ("no.csv", "no.csv")}) is None


NESTED = [{"id": 1, "items": [{"x": 1}, {"x": 2}], "t": "} {"}, {"id": 2, "items": [], "t": None}, {"id": None, "items": None, "t": None}]
NESTED_LAYOUTS = {
    "array": json.dumps(NESTED, indent=2),
    "flat_array": json.dumps(NESTED),
    "commas": ",\n".join(json.dumps(r, indent=2) for r in NESTED) + ",",
    "spread": "\n\n".join(json.dumps(r, indent=1) for r in NESTED),
    "lines": "\n".join(json.dumps(r) for r in NESTED),
    "listed": ",\n".join(json.dumps(r) for r in NESTED),
}


@pytest.mark.parametrize("given", [True, False])
@pytest.mark.parametrize("layout", sorted(NESTED_LAYOUTS))
def test_nested_records_in_every_layout(spark, tmp_path, layout, given):
    path = put(tmp_path / "r.json", NESTED_LAYOUTS[layout])
    schema = schemas.T.StructType.fromDDL("id long, items array<struct<x:long>>, t string") if given else None
    rows = readers.read_any(spark, path, schema=schema).select("id", "items.x", "t").collect()
    key = lambda r: str(r)
    want = [(1, [1, 2], "} {"), (2, [], None), (None, None, None)]
    assert sorted((tuple(r) for r in rows), key=key) == sorted(want, key=key)


def test_found_records_are_read_in_splits(spark, tmp_path):
    path = put(tmp_path / "r.json", NESTED_LAYOUTS["lines"])
    text = readers.read_any(spark, path)._jdf.queryExecution().toString()
    assert "Format: Text" in text and "wholetext" not in text.lower() and "Python" not in text


def test_broken_objects_over_lines_are_skipped(spark, tmp_path):
    path = put(tmp_path / "r.json", '{\n "a": 1\n},\n{\n "a": oops\n},\n{\n "a": 3, "b": {"c": [1, 2]}\n}')
    assert sorted(r.a for r in readers.read_json_records(spark, path, "a int").collect()) == [1, 3]


def _snap(spark, rows):
    return spark.createDataFrame(rows, "k int, snapshot_date string").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date")
    )


def test_emptied_months_are_cleared_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_snapshots(_snap(spark, [(1, "2024-01-01"), (2, "2024-02-01"), (3, "2024-03-01")]), path)
    again = _snap(spark, [(9, "2024-02-01")])
    writers.write_snapshots(again, path, months=["2024-01-01", "2024-02-01", "2023-12-01"])
    assert sorted(r.k for r in readers.read_table(spark, path).collect()) == [3, 9]
    writers.write_snapshots(again.where("false"), path, months=["2024-02-01", "2024-03-01"])
    assert readers.read_table(spark, path).count() == 0 and not list((tmp_path / "t").rglob("part-*"))


def test_late_files_add_to_their_month_and_replays_do_not(spark, tmp_path):
    source, head = tmp_path / "raw", ",".join(schemas.ATTRIBUTES.fieldNames()) + "\n"
    source.mkdir()
    run = lambda: snapshots.clean_arrivals(
        spark, "attributes", str(source), str(tmp_path / "t"), str(tmp_path / "cp")
    ).awaitTermination()
    for i in (1, 2):
        put(source / f"{i}.csv", head + f"C{i},N,30,123-45-6789,Job,2024-05-01\n")
        run()
    run()
    rows = snapshots.read_arrivals(spark, str(tmp_path / "t"), "2024-05-01")
    assert sorted(r.Customer_ID for r in rows.collect()) == ["C1", "C2"] and "arrival" not in rows.columns
    # a batch that is replayed under its own number is not added again
    batch = _snap(spark, [(1, "2024-05-01")])
    for _ in range(2):
        writers.write_snapshots(batch, str(tmp_path / "u"), key="s-0")
    writers.write_snapshots(batch, str(tmp_path / "u"), key="s-1")
    assert readers.read_table(spark, str(tmp_path / "u")).count() == 2


def _raw_loans(spark, path, months):
    columns = schemas.RAW["loans"].fieldNames()
    rows = []
    for m in months:
        for i in (1, 2):
            row = {c: "1" for c in columns} | {
                "loan_id": f"L{i}", "Customer_ID": f"C{i}", "snapshot_date": m, "loan_start_date": "2023-07-01",
                "installment_num": "6", "due_amt": "100", "overdue_amt": "250",
            }
            rows.append(tuple(row[c] for c in columns))
    spark.createDataFrame(rows, schemas.RAW["loans"]).write.mode("overwrite").option("header", True).csv(path)


def test_one_month_run_touches_only_that_month(spark, tmp_path):
    root, raw = str(tmp_path / "mart"), str(tmp_path / "raw")
    _raw_loans(spark, raw, ["2024-01-01", "2024-02-01", "2024-03-01"])
    datamart.backfill(spark, {"loans": raw}, root, "2024-01-01", "2024-03-01")

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").rglob("part-*")}

    before = files()
    datamart.backfill(spark, {"loans": raw}, root, "2024-02-01", "2024-02-01")
    after = files()
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all("snapshot_date=2024-02-01" in str(p) for p in changed)
    months = datamart.months_between(spark, "2024-02-01", "2024-02-01")
    for df in (
        datamart.read_bronze(spark, root, "loans", months),
        datamart._of(readers.read_table(spark, f"{root}/silver/loans"), months),
    ):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def test_gold_needs_its_leading_table_and_unique_keys(spark, tmp_path):
    from tidemark.operators.profile import DuplicateKeys, require_unique_keys

    with pytest.raises(readers.NoData, match="financials"):
        datamart.gold_features(spark, str(tmp_path))
    with pytest.raises(readers.NoData, match="clickstream"):
        datamart.gold_customers(spark, str(tmp_path))
    twice = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "x"), (None, "x")], "Customer_ID string, snapshot_date string")
    with pytest.raises(DuplicateKeys):
        require_unique_keys(twice)
    require_unique_keys(twice.distinct())


def test_monitoring_errors_while_running_become_rows(spark, tmp_path):
    good, bad = str(tmp_path / "a.parquet"), str(tmp_path / "b.csv")
    spark.createDataFrame([(1.0,), (2.0,)], "x double").write.parquet(good)
    put(tmp_path / "b.csv", "y\nword\n")
    out = str(tmp_path / "out")
    failed = monitoring.monitor(spark, good, bad, out).first()
    assert failed.status == "ERROR" and failed.error
    assert monitoring.monitor(spark, good, good, out).first().status == "OK"
    assert sorted(r.status for r in spark.read.json(out).collect()) == ["ERROR", "OK"]


def test_one_scratch_folder_per_session_and_settings_for_any(spark):
    from tidemark import session

    assert session.shared_folder(spark) == session.shared_folder(spark)
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    session.apply_settings(other)
    assert all(other.conf.get(k) == v for k, v in session.RUNTIME_CONF.items())


def test_only_changed_months_are_built_again(spark, tmp_path):
    root, raw = str(tmp_path / "mart"), str(tmp_path / "raw")
    run = lambda **k: datamart.backfill(spark, {"loans": raw}, root, "2024-01-01", "2024-04-01", only_changed=True, **k)

    def state():
        places = ("bronze/loans", "silver/loans", "gold/label_store")
        return {(p, m): v for p in places for m, v in commits.versions(commits.newest(spark, f"{root}/{p}")).items()}

    _raw_loans(spark, raw, ["2024-01-01", "2024-02-01", "2024-03-01"])
    run()
    first = state()
    assert len(first) == 9
    run()
    assert state() == first
    _raw_loans(spark, raw, ["2024-01-01", "2024-02-01"])  # March is withdrawn
    run()
    assert state() == {k: v for k, v in first.items() if k[1] != "2024-03-01"}
    run(rule=datamart.LabelRule(dpd=60))
    changed = {k for k, v in state().items() if first[k] != v}
    assert changed == {("gold/label_store", "2024-01-01"), ("gold/label_store", "2024-02-01")}
    datamart.backfill(spark, {"loans": raw}, root, "2024-02-01", "2024-02-01", datamart.LabelRule(dpd=60))
    assert {k[1] for k, v in state().items() if first[k] != v and k[0] == "bronze/loans"} == {"2024-02-01"}


def test_clean_rows_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Landed text is packed; cleaning reads its files of a month each and deals no row out again."""
    sources = _sources(tmp_path)
    plans, write, bound = {}, commits.write_version, spark.conf.get("spark.sql.files.maxPartitionBytes")

    def recorded(df, path, *args):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans[path.removeprefix(f"{tmp_path}/mart/")] = (args[2:] == (True,), "Exchange" in plan)
        return write(df, path, *args)

    monkeypatch.setattr(commits, "write_version", recorded)
    datamart.backfill(spark, sources, f"{tmp_path}/mart", "2023-07-01", "2023-08-01")
    silver = {p: how for p, how in plans.items() if p.startswith("silver/")}
    assert len(silver) == len(sources) and set(silver.values()) == {(True, False)}
    assert not any(by_month for p, (by_month, _) in plans.items() if p not in silver)
    for entity in sources:
        landed, clean_files = (list((tmp_path / "mart" / at / entity).rglob("part-*")) for at in ("bronze", "silver"))
        assert landed and all(f.name.endswith(".csv.gz") for f in landed) and len(clean_files) <= len(landed)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == bound


def test_raw_files_of_the_datamart_queries_are_packed(spark, sf_dir, tmp_path):
    from tidemark.catalog import sources as queries

    path = queries._land(spark, sf_dir, str(tmp_path), "loans")["loans"]
    files = list((tmp_path / "raw" / "loans").glob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    rows = readers.read_csv(spark, path, schemas.RAW["loans"])
    assert rows.count() == queries.S.loans(spark, sf_dir).count()
