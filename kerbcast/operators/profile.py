"""Zone-hour duration and distance profile with fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast.functions.exact import MICRO, MICROS_PER_MINUTE, exact_sum, exact_sum_or_zero
from kerbcast.operators.grid import with_zone, zone_hour_grid


def zone_hour_sums(partials: DataFrame, zone_map: DataFrame) -> DataFrame:
    return (
        with_zone(partials, zone_map)
        .groupBy("pickup_zone", "hour")
        .agg(
            exact_sum_or_zero("duration_sum", MICROS_PER_MINUTE).alias("duration_sum"),
            F.sum("duration_n").alias("duration_n"),
            exact_sum_or_zero("distance_sum", MICRO).alias("distance_sum"),
            F.sum("distance_n").alias("distance_n"),
        )
    )


def zone_hour_profile(partials: DataFrame, zone_map: DataFrame, n_zones: int) -> DataFrame:
    """Average duration and distance for every zone and hour.

    A zone-hour with no usable measurement takes its zone's mean over all hours, then the
    overall mean, rather than zero.
    """
    filled = zone_hour_grid(partials.sparkSession, n_zones).join(
        zone_hour_sums(partials, zone_map), ["pickup_zone", "hour"], "left"
    )
    # The grid has n_zones * 24 rows whatever the number of trips, so one task can hold
    # it; a second aggregate for the overall mean would read the partials again.
    zone, everything = Window.partitionBy("pickup_zone"), Window.partitionBy(F.lit(0))

    def mean(prefix: str, unit: float) -> Column:
        total, n = F.col(f"{prefix}_sum"), F.col(f"{prefix}_n")
        wider = [
            F.try_divide(exact_sum(total, unit, window), F.sum(n).over(window))
            for window in (zone, everything)
        ]
        return F.coalesce(F.try_divide(total, n), *wider)

    return filled.select(
        "pickup_zone",
        "hour",
        mean("duration", MICROS_PER_MINUTE).alias("avg_ride_duration_min"),
        mean("distance", MICRO).alias("avg_ride_distance"),
    )
