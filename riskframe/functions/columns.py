"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


#: Decimals of the declared money columns.
MONEY_SCALE = 2


def cents(amount: Column, scale: int = MONEY_SCALE) -> Column:
    """Money in whole units of its last declared decimal, so that sums are exact and do not depend on
    the order in which tasks deliver them. What is not finite or does not fit becomes null;
    ``quality.amount_checks`` counts such amounts and those with more decimals."""
    return F.round(amount.try_cast("double") * 10**scale).try_cast("bigint")


def from_cents(value: Column, scale: int = MONEY_SCALE) -> Column:
    return value / F.lit(float(10**scale))


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def flag(condition: Column) -> Column:
    """A condition whose unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def rate4(part: Column, whole: Column) -> Column:
    """part / whole to four digits, half up, in integer arithmetic; 0 for an empty whole."""
    part, whole = part.cast("bigint"), whole.cast("bigint")
    ten_thousandths = F.call_function("div", part * 20000 + whole, whole * 2)
    return F.when(whole > 0, ten_thousandths / F.lit(10000.0)).otherwise(F.lit(0.0))


# ``least`` and ``greatest`` skip nulls; these keep an unknown value unknown.
def at_most(value: Column, high: float) -> Column:
    return F.when(value > high, F.lit(high)).otherwise(value)


def at_least(value: Column, low: float) -> Column:
    return F.when(value < low, F.lit(low)).otherwise(value)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), F.lit(2.0)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(at_most(chord, 1.0)))


def clip(value: Column, low: float, high: float) -> Column:
    return at_most(at_least(value, low), high)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def fingerprint(value: Column, length: int = 40) -> Column:
    """Pseudonymous identifier: leading hex digits of the SHA-256 digest."""
    return F.left(F.sha2(value.cast("string"), 256), F.lit(length))
