"""Event-time windows, de-duplication and enrichment of a transaction stream.

Input streams have the transaction columns; ``timestamp`` is the event time. Rows older than the
watermark are dropped by Spark and reported in the query's progress.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import cents, from_cents
from riskframe.plans.views import UNMAPPED_RISK

WATERMARK = "1 hour"


def _per_window(stream: DataFrame, window: Column, watermark: str) -> DataFrame:
    return (
        stream.withWatermark("timestamp", watermark)
        .groupBy(window.alias("window"), "customer_id")
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum(cents(F.col("amount"))).alias("cents"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "customer_id",
            "txn_count",
            from_cents(F.coalesce("cents", F.lit(0))).alias("spend"),
        )
    )


def tumbling(stream: DataFrame, length: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    return _per_window(stream, F.window("timestamp", length), watermark)


def sliding(
    stream: DataFrame, length: str = "1 hour", step: str = "5 minutes", watermark: str = WATERMARK
) -> DataFrame:
    return _per_window(stream, F.window("timestamp", length, step), watermark)


def sessions(stream: DataFrame, gap: str = "30 minutes", watermark: str = WATERMARK) -> DataFrame:
    return _per_window(stream, F.session_window("timestamp", gap), watermark)


def deduplicated(stream: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """One row per transaction id within the watermark; ids are forgotten afterwards."""
    return stream.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["transaction_id"])


def enriched(stream: DataFrame, device_view: DataFrame, ip_view: DataFrame) -> DataFrame:
    """Attach device and IP risk from static tables; Spark picks the join by their size."""
    return (
        stream.join(device_view.select("device_id", F.col("device_risk_score").alias("_device")), "device_id", "left")
        .join(ip_view.select("ip_address", F.col("ip_risk_score").alias("_ip")), "ip_address", "left")
        .select(
            *stream.columns,
            F.coalesce("_device", F.lit(UNMAPPED_RISK)).alias("device_risk_score"),
            F.coalesce("_ip", F.lit(UNMAPPED_RISK)).alias("ip_risk_score"),
        )
    )
