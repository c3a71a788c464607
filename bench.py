"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the data and
the number of local cores. Names given as arguments replace the headline list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tillroll.plans import PLANS

HEADLINE = [
    "purchase_coupon_outer",
    "feat_shopper",
    "feat_shopper_product",
    "build_features",
    "target_features",
    "lag_weeks",
    "negative_samples",
    "negatives_priced",
    "heuristic_coupons",
    "assign_coupons",
    "uplift_coupons",
    "coupon_hit_rate",
    "star_left",
    "user_order_features",
    "returns_14d_dataset",
    "segment_features",
    "department_share",
    "split_timeseries5",
    "cooccurrence",
    "association_rules",
    "silhouette_exact",
    "auc_exact",
    "itemsets_all_sizes",
    "train_gbt",
    "gbt_returns_14d",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillroll-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        PLANS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
