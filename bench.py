"""Headline queries of one full run, timed step by step."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from offerlens.plans.registry import QUERIES, context

# In pipeline order.  One run, from raw tables: a query builds the stage tables it
# is the first to need and reads those that earlier ones left, so the sum is the
# time of the whole run and nothing is timed twice.
HEADLINE = ["valid_sales", "base_info", "rfm_single_24", "price_exposure", "grid_single",
            "grid_bundle", "peer_history_segment", "peer_fill_single_segment",
            "peer_fill_bundle_segment", "rfm_consolidated", "scores", "probability_plain",
            "final_order", "estimated_totals", "new_purchases", "new_probability",
            "daily_interface_new"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("offerlens-bench")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["base_ordering"](context(spark, folder, fresh=True)).count()      # start-up
    run, seconds = context(spark, folder, fresh=True), {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](run).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "offer_scoring_pipeline_seconds",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
