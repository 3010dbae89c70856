"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from riskframe.plans.catalog import QUERIES
from riskframe.session import SQL_OPTIONS

HEADLINE = (
    "clean_transactions",
    "velocity_features",
    "device_features",
    "ip_features",
    "behavioral_features",
    "fraud_features",
    "credit_features",
    "customer_features",
    "v_customer_features",
    "v_new_device_detection",
    "v_transaction_velocity",
    "dq_report",
    "fraud_rule_flags",
    "expected_loss",
    "customer_components",
    "decision_engine",
    "stream_tumbling_1h",
    "stream_velocity",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("riskframe-bench")
    options = {
        **SQL_OPTIONS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "20g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)  # compiles the generated code
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
