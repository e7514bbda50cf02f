"""Wall-clock of the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Every query is evaluated completely into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from riskweave import build_session
from riskweave.plans.catalog import QUERIES

HEADLINE = [
    "rule_alerts", "alert_append_idempotent", "txn_enriched", "fact_star", "orphan_checks", "check_constraints",
    "dq_credit_rules", "profile_columns", "describe_amounts", "credit_features", "fraud_features", "aml_features",
    "stratified_split", "column_transform", "threshold_sweep", "roc_auc", "model_comparison", "probability_summary",
    "assess_requests", "integrated_dashboard", "channel_risk", "alert_matrix", "vw_transaction_risk",
    "aml_velocity_rule", "aml_structuring_rule",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false",
    })
    spark.read.parquet(f"{folder}/orders.parquet").count()  # start the executors before timing
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline query wall-clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
