"""Rolling transaction counts and spend per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import epoch_micros
from riskframe.operators.skew import DEFAULT_POLICY, SkewPolicy
from riskframe.operators.timeline import RollingWindow, rolling_cuts, rolling_sums
from riskframe.sources.schemas import require

# Window suffix and length in seconds.
HOUR, DAY, WEEK = ("1h", 3600), ("24h", 86_400), ("7d", 604_800)
WINDOWS = (HOUR, DAY, WEEK)
NO_PREVIOUS_SECONDS = 999_999


def velocity_cuts(
    txns: DataFrame, key: str, windows: Sequence[tuple[str, int]] = WINDOWS, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Borders between the slices of large keys, as ``velocity_features`` uses them; the raw scan will do."""
    second = F.col("timestamp").cast("bigint")
    return rolling_cuts(txns, [seconds for _, seconds in windows], tick=second, key=key, policy=policy)


def velocity_features(
    txns: DataFrame,
    windows: Sequence[tuple[str, int]] = WINDOWS,
    *,
    gap: bool = True,
    key: str = "customer_id",
    keep_slice: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Append ``txns_last_*`` (others in the window), ``spend_last_*`` (own row included) and the
    seconds since the previous transaction, on epoch seconds."""
    require(txns, "transaction_id", key, "amount")
    if "timestamp_sec" not in txns.columns:
        txns = txns.withColumn("timestamp_sec", F.col("timestamp").cast("bigint"))
    rolled = rolling_sums(
        txns,
        [RollingWindow(seconds, f"txns_last_{s}", f"spend_last_{s}") for s, seconds in windows],
        tick=F.col("timestamp_sec"),
        counted=F.col("transaction_id").isNotNull(),
        key=key,
        previous_tick_as="_previous" if gap else None,
        keep_slice=keep_slice,
        policy=policy,
        cuts=cuts,
    )
    if not gap:
        return rolled
    since = F.coalesce(F.col("timestamp_sec") - F.col("_previous"), F.lit(NO_PREVIOUS_SECONDS).cast("bigint"))
    return rolled.withColumn("seconds_since_last_txn", since).drop("_previous")


def transaction_velocity_view(
    txns: DataFrame, *, policy: SkewPolicy = DEFAULT_POLICY, cuts: DataFrame | None = None
) -> DataFrame:
    """1-hour and 24-hour windows on exact (microsecond) timestamps."""
    require(txns, "transaction_id", "customer_id", "amount", "timestamp")
    return rolling_sums(
        txns.select("transaction_id", "customer_id", "timestamp", "amount"),
        [
            RollingWindow(3600 * 1_000_000, "txns_last_1_hour", "spend_last_1_hour"),
            RollingWindow(86_400 * 1_000_000, "txns_last_24_hours", "spend_last_24_hours"),
        ],
        tick=epoch_micros(F.col("timestamp")),
        counted=F.lit(True),
        policy=policy,
        cuts=cuts,
    )
