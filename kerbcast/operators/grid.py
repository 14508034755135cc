"""Dense zone-hour and zone-hour-day tables.

Zones are ``0 .. n_zones - 1``.  Grids are generated, not cross-joined, and hold exactly
the rows the result needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.exact import MICROS_PER_MINUTE, exact_mean
from kerbcast.operators.lookups import lookup_join

HOURS = 24


def zone_hour_grid(
    spark: SparkSession, n_zones: int, zone_col: str = "pickup_zone", time_col: str = "hour"
) -> DataFrame:
    """One row per zone and hour of day."""
    zones = spark.range(n_zones).select(F.col("id").cast("int").alias(zone_col))
    return zones.withColumn(time_col, F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))))


def fill_days(
    counts: DataFrame,
    n_zones: int | Column,
    zone_col: str = "pickup_zone",
    time_col: str = "hour",
    by: Sequence[str] = (),
) -> DataFrame:
    """Zero-fill counts over zones x hours x the dates present.

    ``counts`` may hold rows with no zone: they make their date present and vanish.  With
    ``by``, each group is filled on its own and ``n_zones`` may be one of its columns.
    The result has one row per cell.
    """
    zones = F.lit(n_zones) if isinstance(n_zones, int) else n_zones
    group = [*by, "date"]
    every_zone = F.sequence(F.lit(0), zones - 1)
    every_hour = F.sequence(F.lit(0), F.lit(HOURS - 1))
    in_grid = F.col(zone_col).between(F.lit(0), zones - 1)
    cell = F.struct(
        F.col(zone_col).cast("int").alias(zone_col),
        F.col(time_col).cast("int").alias(time_col),
        F.col("ride_count").cast("bigint").alias("ride_count"),
    )
    if not isinstance(n_zones, int) or n_zones * HOURS <= S.GRID_MAX_CELLS_PER_DAY:
        # A day holds at most n_zones * 24 cells, so its counts and its zero cells fit one
        # row; exploding both and adding up stays in the same hash partition.
        zero_cells = F.flatten(
            F.transform(
                every_zone,
                lambda zone: F.transform(
                    every_hour,
                    lambda hour: F.struct(
                        zone.cast("int").alias(zone_col),
                        hour.cast("int").alias(time_col),
                        F.lit(0).cast("bigint").alias("ride_count"),
                    ),
                ),
            )
        )
        cells = (
            counts.groupBy(*group)
            .agg(F.collect_list(F.when(in_grid, cell)).alias("seen"))
            .select(*group, F.explode(F.concat("seen", zero_cells)).alias("cell"))
            .select(*group, "cell.*")
        )
    else:
        zeros = (
            counts.select(*group)
            .distinct()
            .withColumn(zone_col, F.explode(every_zone))
            .withColumn(time_col, F.explode(every_hour))
            .withColumn("ride_count", F.lit(0).cast("bigint"))
        )
        observed = counts.filter(in_grid).select(*group, cell.alias("cell"))
        cells = observed.select(*group, "cell.*").unionByName(zeros)
    return cells.groupBy(*by, zone_col, time_col, "date").agg(
        F.sum("ride_count").alias("ride_count")
    )


def zone_hour_totals(
    trips: DataFrame,
    n_days: int | Column,
    n_zones: int,
    zone_col: str = "pickup_zone",
    time_col: str = "hour",
) -> DataFrame:
    """Totals of one split: rows counted, means over usable measurements, daily rate.

    Every zone and hour has a row; empty ones are all zero.
    """
    seen = trips.groupBy(
        F.col(zone_col).cast("int").alias(zone_col), F.col(time_col).cast("int").alias(time_col)
    ).agg(
        F.count("*").alias("ride_count"),
        exact_mean("ride_duration_min", MICROS_PER_MINUTE).alias("avg_ride_duration_min"),
        exact_mean("ride_distance_km").alias("avg_ride_distance"),
    )
    filled = zone_hour_grid(trips.sparkSession, n_zones, zone_col, time_col).join(
        seen, [zone_col, time_col], "left"
    )
    days = F.lit(n_days) if isinstance(n_days, int) else n_days
    return filled.select(
        zone_col,
        time_col,
        F.coalesce("ride_count", F.lit(0)).alias("ride_count"),
        F.coalesce("avg_ride_duration_min", F.lit(0.0)).alias("avg_ride_duration_min"),
        F.coalesce("avg_ride_distance", F.lit(0.0)).alias("avg_ride_distance"),
        (F.coalesce("ride_count", F.lit(0)) / days).alias("avg_daily_ride_count"),
    )


def distinct_days(trips: DataFrame, time_col: str = "start_time") -> int:
    """Number of calendar days with trips: days are reduced before they are counted."""
    return trips.select(F.col(time_col).cast("date").alias("date")).distinct().count()


def zone_hour_daily(
    trips: DataFrame,
    n_zones: int,
    zone_col: str = "pickup_zone",
    time_col: str = "hour",
) -> DataFrame:
    """Zone-hour-day counts straight from trips, zero-filled over the dates present."""
    counts = (
        trips.withColumn("date", F.col("start_time").cast("date"))
        .groupBy(zone_col, time_col, "date")
        .agg(F.count("*").alias("ride_count"))
    )
    return fill_days(counts, n_zones, zone_col, time_col)


def profile_of_totals(totals: DataFrame) -> DataFrame:
    """The duration and distance columns of zone-hour totals."""
    return totals.select("pickup_zone", "hour", "avg_ride_duration_min", "avg_ride_distance")


def with_zone(partials: DataFrame, zone_map: DataFrame, how: str = "inner") -> DataFrame:
    """Attach ``pickup_zone``; ``zone_map`` holds ``pickup_location_id, pickup_zone``."""
    return lookup_join(partials, zone_map, "pickup_location_id", how)


def zone_hour_daily_from_partials(
    partials: DataFrame, zone_map: DataFrame, n_zones: int
) -> DataFrame:
    """Zone-hour-day counts from partials, zero-filled over the dates present."""
    counts = (
        with_zone(partials, zone_map, "left")
        .groupBy("pickup_zone", "hour", "date")
        .agg(F.sum("ride_count").alias("ride_count"))
    )
    return fill_days(counts, n_zones)
