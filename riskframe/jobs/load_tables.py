"""spark-submit main: load the tables, register the views, run the quality checks.

Exits with 1 when a check fails.

    spark-submit -m riskframe.jobs.load_tables --data-dir ... --database banking
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from riskframe.operators.quality import all_passed, quality_report
from riskframe.plans.views import new_device_sample, new_device_summary, register_views
from riskframe.session import configure, get_session
from riskframe.sources.schemas import LOAD_ORDER, TABLES
from riskframe.sources.tables import Sink, catalog_sink, load_all


def run(
    spark: SparkSession, data_dir: str, sink: Sink, loaded, *, truncate_first: bool = True
) -> tuple[dict[str, int], DataFrame]:
    """Load, register and check; ``loaded(name)`` reads a table back. Returns counts and report."""
    configure(spark)
    counts = load_all(spark, data_dir, sink, truncate_first=truncate_first)
    empty = {n: spark.createDataFrame([], TABLES[n].schema) for n in LOAD_ORDER if not counts[n]}
    tables = {n: empty[n] if n in empty else loaded(n) for n in LOAD_ORDER}
    register_views(tables)
    return counts, quality_report(tables)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--database", default="banking")
    parser.add_argument("--skip-truncate", action="store_true")
    args = parser.parse_args()
    spark = get_session("riskframe-load-tables")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
    counts, report = run(
        spark,
        args.data_dir,
        catalog_sink(args.database),
        lambda name: spark.table(f"{args.database}.{name}"),
        truncate_first=not args.skip_truncate,
    )
    for name, rows in counts.items():
        print(f"{name}: {rows} rows")
    report = report.persist()
    report.show(50, truncate=False)
    detection = spark.table("v_new_device_detection")
    new_device_sample(detection).show(truncate=False)
    new_device_summary(detection).show(truncate=False)
    passed = all_passed(report).first()["passed"]
    spark.stop()
    sys.exit(0 if passed else 1)


if __name__ == "__main__":
    main()
