"""spark-submit main: clean the tables and write the three feature datasets.

    spark-submit -m riskframe.jobs.build_features --input-dir ... --output-dir ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.operators.skew import DEFAULT_POLICY, OWNER, SkewPolicy, with_owner
from riskframe.operators.velocity import velocity_cuts
from riskframe.plans.features import credit_features, customer_features, feature_summary, fraud_features
from riskframe.session import configure, get_session, staged, work_path
from riskframe.sources.tables import read_all, write_datasets


def feature_datasets(raw: dict[str, DataFrame], policy: SkewPolicy = DEFAULT_POLICY) -> dict[str, DataFrame]:
    """The three datasets from raw tables. Cleaned transactions feed all of them and are therefore
    written once to the shared folder instead of being de-duplicated three times."""
    spark = raw["transactions"].sparkSession
    folder = work_path(spark, "features")
    txns = staged(clean.clean_transactions(raw["transactions"]), f"{folder}/transactions")
    cuts = staged(velocity_cuts(with_owner(txns), OWNER, policy=policy), f"{folder}/cuts")
    customers = clean.clean_customers(raw["customers"])
    return {
        "fraud_features": fraud_features(
            txns,
            clean.clean_devices(raw["devices"]),
            raw["customer_devices"],
            clean.clean_ip_addresses(raw["ip_addresses"]),
            raw["customer_ips"],
            customers,
            clean.clean_merchants(raw["merchants"]),
            policy=policy,
            cuts=cuts,
        ),
        "credit_features": credit_features(clean.clean_loans(raw["loans"]), customers, txns),
        "customer_features": customer_features(customers, txns),
    }


def run(spark: SparkSession, input_dir: str, output_dir: str, *, by_day: bool = False) -> dict[str, int]:
    """Write the datasets and return their row counts. ``by_day`` lays fraud features out in day
    folders, so that readers skip days; rebalancing keeps files of even size whatever the day holds."""
    configure(spark)
    datasets = feature_datasets(read_all(spark, input_dir))
    partitions = {}
    if by_day:
        dated = datasets["fraud_features"].withColumn("txn_date", F.to_date("timestamp"))
        datasets["fraud_features"] = dated.hint("rebalance", "txn_date")
        partitions["fraud_features"] = ("txn_date",)
    return write_datasets(datasets, output_dir, partitions)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input-dir", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--by-day", action="store_true")
    args = parser.parse_args()
    spark = get_session("riskframe-build-features")
    for name, rows in run(spark, args.input_dir, args.output_dir, by_day=args.by_day).items():
        print(f"{name}: {rows} rows")
    feature_summary(spark.read.parquet(f"{args.output_dir.rstrip('/')}/fraud_features.parquet")).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
