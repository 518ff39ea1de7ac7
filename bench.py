"""Time the headline queries: ``python bench.py [name ...]``.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``; prints one line of JSON.
"""

from __future__ import annotations

import json
import os
import sys
import time

from basketlens.functions.shared_tables import delete_written_tables
from basketlens.plans import all_plans
from basketlens.session import build_session

HEADLINE = [
    "kpi_summary",
    "repeat_purchase",
    "top_categories",
    "avg_days_between_orders",
    "revenue_summary",
    "retention_cohort",
    "rfm_segments",
    "category_affinity",
    "price_sensitivity",
    "temporal_preferences",
    "customer_features",
    "price_histogram",
    "time_split",
    "frequent_pairs",
    "association_rules",
    "itemset_rules",
    "copurchase_pairs",
    "recommend_popular",
    "recommend_copurchase",
    "recommend_hybrid",
    "recommend_category",
    "recommend_content",
    "recommend_factors",
    "evaluate_methods",
    "churn_dataset_last_order",
    "churn_dataset_rfm",
    "smote_rows",
    "train_churn",
    "compare_models",
    "profile_columns",
    "iqr_outliers",
    "quality_score",
    "experiment_results",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans = all_plans()
    # the first query would otherwise pay for starting the JVM's code paths
    plans["order_status_distribution"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        plans[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    delete_written_tables(spark)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
