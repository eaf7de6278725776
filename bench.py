"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from skein.plans import catalog

HEADLINE = (
    "q_claims_by_type", "q_sentences", "q_prev_context", "q_needs_refine", "q_token_tf", "q_label_top3", "q_knn_cross_source",
    "q_lit_dim", "q_tensions", "q_seen_antijoin", "q_assign_ids", "q_dedupe_first", "q_pending_by_kind", "q_signal_stage1",
    "q_signal_capped", "q_direction_rank", "q_cruxes", "q_risk_adjusted", "q_jitter", "q_page_hash", "q_strip_html", "q_anchor_assign",
)


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/region.parquet").count()
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rstrip("/").rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
