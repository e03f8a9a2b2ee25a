"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlift.plans.queries import publish, registered  # noqa: E402
from adlift.session import build_session  # noqa: E402

HEADLINE = [
    "attribution_asof",
    "attribution_global_last",
    "attribution_full",
    "attribution_summary",
    "dedup_orders",
    "gold_customer_features",
    "gold_customer_features_sparse",
    "gold_merchant_features",
    "line_merchant_features",
    "line_customer_order_agg",
    "rolling_customer_features",
    "training_set",
    "training_set_point_in_time",
    "batch_lookup_defaults",
    "feature_skew_report",
    "binary_metrics",
    "stratified_split",
    "creative_decisions_egreedy",
    "creative_decisions_thompson",
    "advertiser_rollup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "adlift-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()

    timings: dict[str, float] = {}

    def timed(name, work) -> None:
        start = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - start, 3)

    def build_layers() -> None:
        publish(spark, sf_dir)

    # Bronze, silver and gold written to files, as the stages after them read them.
    timed("build_layers", build_layers)
    named = registered()
    for name in HEADLINE:
        timed(name, lambda: named[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
