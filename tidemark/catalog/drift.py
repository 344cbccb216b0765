"""Population drift and monitoring."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.operators import drift, metrics, profile
from tidemark.plans import profiles
from tidemark.session import shared_folder
from tidemark.settings import MonitorRule
from tidemark.sources import surrogates as S


def _halves(spark, sf_dir, columns=("value", "user_id", "event_type")):
    events = S.table(spark, sf_dir, "events")
    return (
        events.where("ts < '2024-01-16'").select(*columns),
        events.where("ts >= '2024-01-16'").select(*columns),
    )


def _psi_sql(columns):
    """PSI in SQL: right-closed equal-width bins of the reference, empty bins kept."""
    parts, names = [], []
    for i, c in enumerate(columns):
        edges = ["a - 0.001::double*(b-a)", *[f"a + {k}*((b-a)/10)" for k in range(1, 10)], "b"]
        inner = " + ".join(f"(x > {e})::int" for e in edges[1:-1])
        parts.append(
            f"""e{i} AS (SELECT min({c})::double AS a, max({c})::double AS b FROM events WHERE ts < TIMESTAMP '2024-01-16'),
 b{i} AS (SELECT ts < TIMESTAMP '2024-01-16' AS ref, CASE WHEN x < {edges[0]} OR x > {edges[-1]} THEN NULL ELSE 1 + {inner} END AS bin
  FROM (SELECT ts, {c}::double AS x FROM events WHERE {c} IS NOT NULL), e{i}),
 c{i} AS (SELECT g.bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM (SELECT unnest(range(1, 11)) AS bin) g
  LEFT JOIN (SELECT bin, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM b{i} WHERE bin IS NOT NULL GROUP BY bin) n ON g.bin = n.bin),
 s{i} AS (SELECT r::double/sum(r) OVER () + 1e-10 AS p, c::double/sum(c) OVER () + 1e-10 AS q FROM c{i})"""
        )
        names.append(f"SELECT '{c}' AS feature, sum((q-p)*ln(q/p)) AS psi FROM s{i}")
    return ", ".join(parts) + ", psi AS (" + " UNION ALL ".join(names) + ")"


_PSI = _psi_sql(["value", "user_id"])


@query("mon_psi", f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi(spark, sf_dir):
    out = drift.psi(*_halves(spark, sf_dir))
    return out.withColumn("psi", F.round("psi", 6))


@query(
    "mon_psi_loan_amounts",
    f"""WITH {
        _psi_sql(["l_extendedprice", "l_quantity", "l_discount"])
        .replace("FROM events", "FROM lineitem")
        .replace("ts < TIMESTAMP '2024-01-16'", "l_shipdate < TIMESTAMP '1998-06-01'")
        .replace("SELECT ts, ", "SELECT l_shipdate, ")
    } SELECT feature, round(psi, 6) AS psi FROM psi""",
)
def psi_loan_amounts(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    columns = ["l_extendedprice", "l_quantity", "l_discount"]
    out = drift.psi(
        lines.where("l_shipdate < '1998-06-01'").select(columns),
        lines.where("l_shipdate >= '1998-06-01'").select(columns),
    )
    return out.withColumn("psi", F.round("psi", 6))


@query(
    "mon_psi_drift",
    f"WITH {_PSI} SELECT feature, round(psi, 6) AS psi, 0.003::double AS threshold, psi > 0.003 AS drift_detected FROM psi",
)
def psi_drift(spark, sf_dir):
    out = drift.psi_drift(*_halves(spark, sf_dir), rule=MonitorRule(psi_threshold=0.003))
    return out.withColumn("psi", F.round("psi", 6))


@query(
    "mon_drift_summary",
    f"""WITH {_PSI} SELECT count(*) AS total_features_analyzed, count(*) AS numeric_features, count(*) FILTER (psi > 0.003) AS features_with_drift,
 round(count(*) FILTER (psi > 0.003)*100.0::double/count(*), 6) AS drift_percentage FROM psi""",
)
def drift_summary(spark, sf_dir):
    table = drift.psi_drift(*_halves(spark, sf_dir), rule=MonitorRule(psi_threshold=0.003))
    return drift.drift_summary(table).withColumn("drift_percentage", F.round("drift_percentage", 6))


@query(
    "mon_mean_shift",
    """WITH r AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(user_id) AS mu, stddev_samp(user_id) AS su FROM events WHERE ts < TIMESTAMP '2024-01-16'),
 c AS (SELECT avg(value + 100000) AS mv, avg(user_id) AS mu FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
 d AS (SELECT (abs(c.mv-r.mv) > 2*r.sv)::int + (abs(c.mu-r.mu) > 2*r.su)::int AS drift_count FROM r, c)
 SELECT drift_count, drift_count/2.0::double AS drift_share, drift_count/2.0 > 0.2 AS drift_detected,
 CASE WHEN drift_count/2.0 > 0.2 THEN 'ALERT' ELSE 'OK' END AS status, 'manual_statistical' AS method FROM d""",
)
def mean_shift(spark, sf_dir):
    """One of two columns has moved far off."""
    reference, current = _halves(spark, sf_dir)
    return drift.mean_shift(reference, current.withColumn("value", F.col("value") + 100000))


def _ks(c):
    return f"""SELECT '{c}' AS feature, max(abs(cr::double/nr - cc::double/nc)) AS distance FROM (
 SELECT sum(r) OVER (ORDER BY v) AS cr, sum(c) OVER (ORDER BY v) AS cc, sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM (
 SELECT {c} AS v, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS r, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS c FROM events WHERE {c} IS NOT NULL GROUP BY {c}))"""


_JS = """SELECT 'event_type' AS feature, sum(CASE WHEN p > 0 THEN p*log2(p/((p+q)/2)) ELSE 0 END + CASE WHEN q > 0 THEN q*log2(q/((p+q)/2)) ELSE 0 END)/2 AS distance FROM (
 SELECT r::double/sum(r) OVER () AS p, c::double/sum(c) OVER () AS q FROM (
 SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS r, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS c FROM events GROUP BY event_type))"""


@query(
    "mon_ks_distance",
    f"WITH k AS ({_ks('value')} UNION ALL {_ks('user_id')}) SELECT feature, round(distance, 6) AS distance FROM k",
)
def ks_distance(spark, sf_dir):
    out = drift.ks_distance(*_halves(spark, sf_dir))
    return out.withColumn("distance", F.round("distance", 6))


@query("mon_js_divergence", f"WITH k AS ({_JS}) SELECT feature, round(distance, 6) AS distance FROM k")
def js_divergence(spark, sf_dir):
    out = drift.js_divergence(*_halves(spark, sf_dir), ["event_type"])
    return out.withColumn("distance", F.round("distance", 6))


@query(
    "mon_dataset_drift",
    f"""WITH k AS ({_ks('value')} UNION ALL {_ks('user_id')} UNION ALL {_JS}), s AS (SELECT count(*) FILTER (distance > 0.01)::double/count(*) AS x FROM k)
 SELECT CASE WHEN x >= 0.5 THEN 'DRIFT_DETECTED' ELSE 'OK' END AS status, x >= 0.5 AS drift_detected, round(x, 6) AS drift_score, 'distribution_distance' AS method FROM s""",
)
def dataset_drift(spark, sf_dir):
    out = drift.dataset_drift(*_halves(spark, sf_dir), threshold=0.01)
    return out.withColumn("drift_score", F.round("drift_score", 6))


@query(
    "mon_alerts",
    f"""WITH {_PSI}, q AS (SELECT 100.0::double*(count(*) - count(nullif(event_type, 'click')))/(count(*)*3) AS pct FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
 d AS (SELECT count(*) AS n, count(*) FILTER (psi > 0.003) AS k FROM psi),
 m AS (SELECT concat_ws(' | ', CASE WHEN pct > 5 THEN printf('Data quality issue: %.1f%% missing values', round(pct, 2)) END,
  CASE WHEN k > 0 THEN printf('PSI drift detected: %d/%d features (%.1f%%)', k, n, k*100.0::double/n) END) AS alerts FROM q, d)
 SELECT alerts, CASE WHEN alerts = '' THEN 'OK' ELSE 'ALERT' END AS status FROM m""",
)
def alerts(spark, sf_dir):
    rule = MonitorRule(psi_threshold=0.003, missing_alert_pct=5.0, missing_warning_pct=2.0)
    reference, current = _halves(spark, sf_dir)
    gaps = current.withColumn("event_type", F.nullif("event_type", F.lit("click")))
    out = drift.alerts(
        profile.quality(gaps, rule),
        drift.drift_summary(drift.psi_drift(reference, current, rule)),
    )
    return out.withColumn("alerts", F.concat_ws(" | ", "alerts"))


def flat_summary(summary):
    """The nested monitoring document as plain columns, without its time stamp."""
    psi = lambda c: F.round(F.col("psi_drift_results.psi_results")[c]["psi"], 6)
    found = F.col("psi_drift_results.summary")
    return summary.select(
        F.element_at("current_data_shape", 1).cast("bigint").alias("current_rows"),
        F.element_at("current_data_shape", 2).cast("bigint").alias("current_columns"),
        F.element_at("reference_data_shape", 1).cast("bigint").alias("reference_rows"),
        F.col("data_quality.status").alias("quality_status"),
        F.col("data_quality.missing_values").alias("missing_values"),
        found["total_features_analyzed"].alias("features"),
        found["features_with_drift"].alias("drifted"),
        psi("value").alias("psi_value"),
        psi("user_id").alias("psi_user_id"),
        F.size("alerts").alias("n_alerts"),
        "status",
    )


def summary_sql(columns, numeric, error=None):
    """Twin of ``flat_summary`` for the two halves of the events."""
    missing = " + ".join(f"count(*) - count({c})" for c in columns)
    flags = ", ".join(f"max(psi) FILTER (feature = '{c}') AS p_{c}" for c in numeric)
    failed = f", '{error}' AS failed_run" if error else ""
    return f"""WITH {_psi_sql(numeric)},
 c AS (SELECT count(*) AS n, {missing} AS gaps FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
 r AS (SELECT count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16'),
 d AS (SELECT count(*) AS k, count(*) FILTER (psi > 0.1) AS drifted, {flags} FROM psi),
 q AS (SELECT CASE WHEN gaps*100.0/(n*{len(columns)}) > 20 THEN 'ALERT' WHEN gaps*100.0/(n*{len(columns)}) > 10 THEN 'WARNING' ELSE 'OK' END AS s FROM c),
 a AS (SELECT (s = 'ALERT')::int + (drifted > 0)::int AS n FROM q, d)
 SELECT c.n AS current_rows, {len(columns)}::bigint AS current_columns, r.n AS reference_rows, s AS quality_status, gaps AS missing_values,
  k AS features, drifted, round(p_value, 6) AS psi_value, round(p_user_id, 6) AS psi_user_id, a.n AS n_alerts,
  CASE WHEN a.n > 0 THEN 'ALERT' ELSE 'OK' END AS status{failed} FROM c, r, d, q, a"""


@query("mon_summary_document", summary_sql(["event_type", "user_id", "value"], ["value", "user_id"]))
def summary_document(spark, sf_dir):
    reference, current = _halves(spark, sf_dir)
    return flat_summary(drift.monitoring_summary(reference, current, source="events"))


@query(
    "mon_label_vs_prediction",
    f"""WITH {V.DECIDED} SELECT dataset, count(*) FILTER (label=0) AS label_0, count(*) FILTER (label=1) AS label_1,
 count(*) FILTER (prediction=0) AS prediction_0, count(*) FILTER (prediction=1) AS prediction_1,
 round(avg(label), 6) AS actual_positive_rate, round(avg(prediction), 6) AS predicted_positive_rate,
 round(avg(prediction) - avg(label), 6) AS difference, count(*) AS sample_size FROM decided GROUP BY dataset""",
)
def label_vs_prediction(spark, sf_dir):
    """Labels joined to predictions per dataset, then counts and rates side by side."""
    scores = S.scores(spark, sf_dir)
    truth = scores.select("Customer_ID", "dataset", "label")
    predicted = metrics.decide(scores).select("Customer_ID", "dataset", "prediction")
    joined = metrics.labels_with_predictions(truth, predicted, ["Customer_ID", "dataset"])
    out = metrics.distribution_comparison(joined)
    rates = ["actual_positive_rate", "predicted_positive_rate", "difference"]
    return out.withColumns({c: F.round(c, 6) for c in rates})


@query(
    "jon_labels_predictions",
    f"WITH {V.DECIDED} SELECT Customer_ID, dataset, label, prediction FROM decided",
)
def labels_predictions(spark, sf_dir):
    scores = S.scores(spark, sf_dir)
    truth = scores.select("Customer_ID", "dataset", "label")
    predicted = metrics.decide(scores).select("Customer_ID", "dataset", "prediction")
    return metrics.labels_with_predictions(truth, predicted, ["Customer_ID", "dataset"])


_MONTHLY = "SELECT cast(date_trunc('month', l_shipdate) as date) AS snapshot_date, l_extendedprice, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS l_quantity FROM lineitem"


def _monthly(spark, sf_dir):
    quantity = F.when(F.col("l_linenumber") != 3, F.col("l_quantity"))
    return S.table(spark, sf_dir, "lineitem").select(
        F.trunc("l_shipdate", "month").cast("date").alias("snapshot_date"), "l_extendedprice", quantity.alias("l_quantity")
    )


def _stored_states(spark, sf_dir):
    """Three runs: the reference years, all later months, and one month again; each reads its own rows."""
    path = f"{shared_folder(spark)}/tidemark/{spark.sql('SELECT uuid()').first()[0]}"
    rows = _monthly(spark, sf_dir)
    for months in ("snapshot_date < '1996-01-01'", "snapshot_date >= '1996-01-01'", "snapshot_date = '1997-05-01'"):
        profiles.update(rows.where(months), path, ["l_extendedprice", "l_quantity"])
    return path


def _monthly_psi_sql(column):
    edges = [f"a + {k}*((b-a)/10)" for k in range(1, 10)]
    return f"""SELECT snapshot_date, '{column}' AS feature, round(sum((q-p)*ln(q/p)), 6) AS psi FROM (
 SELECT snapshot_date, r::double/sum(r) OVER (PARTITION BY snapshot_date) + 1e-10 AS p, c::double/sum(c) OVER (PARTITION BY snapshot_date) + 1e-10 AS q FROM (
  SELECT snapshot_date, bin, c, sum(CASE WHEN snapshot_date < DATE '1996-01-01' THEN c ELSE 0 END) OVER (PARTITION BY bin) AS r FROM (
   SELECT g.snapshot_date, g.bin, count(x) AS c FROM (SELECT DISTINCT snapshot_date, bin FROM m, range(1, 11) t(bin)) g
   LEFT JOIN (SELECT snapshot_date, x, 1 + {" + ".join(f"(x > {e})::int" for e in edges)} AS bin
    FROM (SELECT snapshot_date, {column}::double AS x FROM m),
    (SELECT min({column})::double AS a, max({column})::double AS b FROM m WHERE snapshot_date < DATE '1996-01-01')
    WHERE x BETWEEN a - 0.001::double*(b-a) AND b) n ON g.snapshot_date = n.snapshot_date AND g.bin = n.bin GROUP BY ALL))) GROUP BY snapshot_date"""


@query(
    "mon_psi_by_month",
    f"WITH m AS ({_MONTHLY}) {_monthly_psi_sql('l_extendedprice')} UNION ALL {_monthly_psi_sql('l_quantity')}",
)
def psi_by_month(spark, sf_dir):
    """Drift of every month against the first years, from stored states: no old row is read again."""
    out = profiles.psi(spark, _stored_states(spark, sf_dir), F.col("snapshot_date") < "1996-01-01")
    return out.withColumn("psi", F.round("psi", 6))


_PROFILE_SQL = """SELECT {by} AS until, '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS missing_count, round(avg({c}), 6) AS mean,
 round(stddev_samp({c}), 6) AS std, min({c})::double AS low, max({c})::double AS high, true AS median_close, true AS distinct_close FROM {t} GROUP BY {by}"""


@query(
    "agg_rolling_profile",
    f"""WITH m AS ({_MONTHLY}), ends AS (SELECT DISTINCT snapshot_date AS until FROM m),
 w AS (SELECT until, m.* FROM ends JOIN m ON snapshot_date BETWEEN until - to_months(2) AND until) """
    + " UNION ALL ".join(
        _PROFILE_SQL.format(by=by, c=c, t=t)
        for c in ("l_extendedprice", "l_quantity")
        for by, t in (("until", "w"), ("DATE '9999-01-01'", "m"))
    ),
)
def rolling_profile(spark, sf_dir):
    """Profiles over three months up to each, and over all, from stored states.

    Medians and distinct values come from sketches: they must lie where the sketches' errors allow.
    """
    path = _stored_states(spark, sf_dir)
    whole = profiles.profile(spark, path).withColumn("until", F.lit("9999-01-01").cast("date"))
    out = profiles.rolling(spark, path, 3).unionByName(whole)
    rows = _monthly(spark, sf_dir)
    month = F.col("snapshot_date")
    long = rows.unpivot("snapshot_date", ["l_extendedprice", "l_quantity"], "feature", "value").where("value IS NOT NULL")
    ends = F.explode(F.array(month, F.add_months(month, 1), F.add_months(month, 2), F.lit("9999-01-01").cast("date")))
    exact = long.withColumn("until", ends).groupBy("until", "feature").agg(
        F.percentile("value", F.array(F.lit(0.47), F.lit(0.53))).alias("middle"), F.count_distinct("value").alias("u")
    )
    joined = out.join(exact, ["until", "feature"])
    error = F.abs(F.col("distinct_estimate") - F.col("u")) / F.col("u")
    return joined.select(
        "until", "feature", "rows", "missing_count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "low", "high",
        F.col("median_estimate").between(F.col("middle")[0], F.col("middle")[1]).alias("median_close"),
        (error < 0.08).alias("distinct_close"),
    )
