"""Sums that do not depend on row order.

Adding doubles in a different order changes the last digits, so a retried task or
another partitioning would change results.  These sums add whole multiples of a unit
instead, which is associative.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000.0
MICRO = 1_000_000.0
_LOW_BITS = 20


def exact_sum(
    value: Column | str, per_unit: float = MICRO, over: WindowSpec | None = None, wide: bool = False
) -> Column:
    """Sum of ``value`` held in steps of ``1 / per_unit``; NULL if nothing is summed.

    Steps are 64-bit integers whose high and low parts are added apart, so that trillions
    of rows do not overflow while the work stays in generated code (a 38-digit decimal sum
    measured seven times slower).  A single value beyond 64 bits raises; ``wide`` sums
    such values, of up to 38 digits in all, as decimals.
    """
    value = F.col(value) if isinstance(value, str) else value
    if wide:
        steps = F.rint(value * F.lit(per_unit)).cast("decimal(38,0)")
        return (F.sum(steps) if over is None else F.sum(steps).over(over)).cast("double") / F.lit(per_unit)
    steps = F.rint(value * F.lit(per_unit)).cast("bigint")
    parts = (F.shiftright(steps, _LOW_BITS), steps.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    high, low = (F.sum(part) if over is None else F.sum(part).over(over) for part in parts)
    total = high.cast("decimal(28,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low.cast(
        "decimal(20,0)"
    )
    return total.cast("double") / F.lit(per_unit)


def exact_sum_or_zero(value: Column | str, per_unit: float = MICRO) -> Column:
    return F.coalesce(exact_sum(value, per_unit), F.lit(0.0))


def exact_mean(value: Column | str, per_unit: float = MICRO, wide: bool = False) -> Column:
    """Mean over non-missing values; NULL if there are none."""
    return F.try_divide(exact_sum(value, per_unit, wide=wide), F.count(value))
