"""Data quality counts and descriptive tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast.functions.exact import MICROS_PER_MINUTE, exact_sum
from kerbcast.functions.geo import in_service_area
from kerbcast.operators.lookups import lookup_join
from kerbcast.operators.order_stats import exact_quantiles, value_counts
from kerbcast.session import settle

COORDINATES = ("start_lat", "start_lng", "end_lat", "end_lng")


def duplicate_and_span_counts(
    rows: DataFrame, columns: Sequence[str], span: str
) -> DataFrame:
    """Exact duplicate rows (beyond the first) and rows with a non-positive span.

    Copies combine before the shuffle, so a large group of them costs one row per task.
    """
    groups = rows.groupBy(*dict.fromkeys([*columns, span])).agg(F.count("*").alias("copies"))
    not_positive = F.when(F.col(span) <= 0, F.col("copies")).otherwise(0)
    return groups.agg(
        F.sum("copies").alias("n_rows"),
        F.sum(F.col("copies") - 1).alias("duplicate_rows"),
        F.sum(not_positive).alias("non_positive_spans"),
    )


def temporal_profile(partials: DataFrame, by: str) -> DataFrame:
    """Rides and mean duration by ``hour`` or ``day_of_week``, from partials."""
    if by == "day_of_week":
        partials = partials.withColumn(by, F.weekday("date"))
    minutes = exact_sum("duration_sum", MICROS_PER_MINUTE)
    return partials.groupBy(by).agg(
        F.sum("ride_count").alias("rides"),
        F.try_divide(minutes, F.sum("duration_n")).alias("mean_duration_min"),
    )


def peak_and_trough(profile: DataFrame, by: str) -> DataFrame:
    """The busiest and the quietest value of ``by`` (the smallest on ties)."""
    return profile.agg(
        F.max_by(by, F.struct("rides", -F.col(by))).alias(f"peak_{by}"),
        F.max("rides").alias("peak_rides"),
        F.min_by(by, F.struct("rides", by)).alias(f"trough_{by}"),
        F.min("rides").alias("trough_rides"),
    )


def daily_series(partials: DataFrame, shock_share: float = 0.5) -> DataFrame:
    """Rides per day with their share of the median day; low shares are shocks."""
    daily = partials.groupBy("date").agg(F.sum("ride_count").alias("rides"))
    # One row per calendar day.
    share = F.col("rides") / F.median("rides").over(Window.partitionBy(F.lit(0)))
    return daily.select(
        "date", "rides", share.alias("share_of_median"), (share < shock_share).alias("is_shock")
    )


def iqr_outlier_shares(
    trips: DataFrame, columns: Sequence[str] = COORDINATES, reach: float = 1.5
) -> DataFrame:
    """Share of rows outside the quartile fences, per column.

    Trips are read once, to count each distinct value; ranks and shares come from the counts.
    """
    counted = settle(value_counts(trips, columns))
    quartiles = exact_quantiles(counted, columns, [0.25, 0.75], "n")
    measures = []
    for name in columns:
        q1, q3 = quartiles[name]
        if q1 is None:
            continue
        low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        outside = (F.col(name) < low) | (F.col(name) > high)
        outliers = F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0))
        measures += [
            F.struct(
                F.lit(name).alias("coordinate"),
                F.lit(low).alias("low_fence"),
                F.lit(high).alias("high_fence"),
                outliers.alias("outliers"),
                F.try_divide(outliers, F.sum(F.when(F.col(name).isNotNull(), F.col("n")))).alias("outlier_share"),
            )
        ]
    if not measures:
        kind = "coordinate string, low_fence double, high_fence double, outliers bigint, outlier_share double"
        return trips.sparkSession.createDataFrame([], kind)
    return counted.agg(F.array(*measures).alias("_found")).select(F.inline("_found"))


def boundary_outliers(trips: DataFrame) -> DataFrame:
    """Trips with any known coordinate outside the service area."""
    bad_start = ~F.coalesce(in_service_area(F.col("start_lat"), F.col("start_lng")), F.lit(True))
    bad_end = ~F.coalesce(in_service_area(F.col("end_lat"), F.col("end_lng")), F.lit(True))
    return trips.agg(
        F.count("*").alias("n_rows"),
        F.count_if(bad_start).alias("bad_start"),
        F.count_if(bad_end).alias("bad_end"),
        F.count_if(bad_start | bad_end).alias("outliers"),
        F.try_divide(F.count_if(bad_start | bad_end), F.count("*")).alias("outlier_share"),
    )


def with_calendar(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Join a supplied one-row-per-date table (holidays, weather) by date."""
    return lookup_join(daily, calendar, "date", "left")
