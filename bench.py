"""Time the headline queries once each, after one warm-up, and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "agg_bad_rate_by_mob",
    "drv_label_store",
    "cal_backfill_labels",
    "cln_silver_attributes",
    "cln_silver_financials",
    "jon_gold_feature_store",
    "enc_category_codes",
    "agg_missing_profile",
    "agg_column_statistics",
    "qlt_duplicate_keys",
    "smp_stratified_split_loans",
    "mdl_standard_scaling",
    "imp_simple_fills",
    "evl_auc_whole_table",
    "evl_dataset_comparison",
    "mon_psi_loan_amounts",
    "mon_ks_distance",
    "scr_batch",
    "snk_idempotent_snapshots",
    "imp_nearest_neighbours",
    "imp_chained_equations",
    "dmt_gold_features",
    "dmt_customers",
    "mdl_logistic_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, **{"spark.ui.showConsoleProgress": "false"})

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(HEADLINE[0])
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
