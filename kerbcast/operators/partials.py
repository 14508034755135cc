"""Location-hour-day partials: the small, mergeable table everything else is built on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.clock import month_text, to_month
from kerbcast.functions.exact import MICRO, MICROS_PER_MINUTE, exact_sum_or_zero
from kerbcast.operators.cleaning import measure_trips

PARTIAL_KEYS = ("pickup_location_id", "date", "hour")
PARTIAL_MEASURES = ("ride_count", "duration_sum", "duration_n", "distance_sum", "distance_n")


def location_hour_daily(trips: DataFrame) -> DataFrame:
    """Counts, and sums with their own non-missing counts, per location, date and hour.

    Sums and counts rather than means, so that any coarser grouping, a later append and a
    stream can merge them.  Rows of a hot location combine before the shuffle.
    """
    keyed = trips.select(
        "pickup_location_id",
        F.col("start_time").cast("date").alias("date"),
        F.hour("start_time").alias("hour"),
        "ride_duration_min",
        "ride_distance_km",
    )
    return keyed.groupBy(*PARTIAL_KEYS).agg(
        F.count("*").alias("ride_count"),
        exact_sum_or_zero("ride_duration_min", MICROS_PER_MINUTE).alias("duration_sum"),
        F.count("ride_duration_min").alias("duration_n"),
        exact_sum_or_zero("ride_distance_km", MICRO).alias("distance_sum"),
        F.count("ride_distance_km").alias("distance_n"),
    )


def known_locations(partials: DataFrame, centroids: DataFrame) -> DataFrame:
    """Partials of locations that have a centre point."""
    known = centroids.select(F.col("location_id").alias("pickup_location_id"))
    return partials.join(known, "pickup_location_id", "left_semi")


def partials_from_trips(
    trips: DataFrame,
    first_month: str | dt.date,
    centroids: DataFrame,
    n_months: int = 1,
) -> DataFrame:
    """Normalized trips to partials, with no join on the trip side.

    Dropping unmapped pickups commutes with grouping by location, so the lookup meets the
    reduced rows instead of every trip.
    """
    return known_locations(
        location_hour_daily(measure_trips(trips, first_month, n_months)), centroids
    )


def merge_partials(*parts: DataFrame) -> DataFrame:
    """Stack partial tables and add up rows that share a key."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy(*PARTIAL_KEYS).agg(
        F.sum("ride_count").alias("ride_count"),
        exact_sum_or_zero("duration_sum", MICROS_PER_MINUTE).alias("duration_sum"),
        F.sum("duration_n").alias("duration_n"),
        exact_sum_or_zero("distance_sum", MICRO).alias("distance_sum"),
        F.sum("distance_n").alias("distance_n"),
    )


def months_of(partials: DataFrame, months: Sequence[str | dt.date]) -> DataFrame:
    """Partials of the given months, as date ranges that reach the scan."""
    condition = F.lit(False)
    for first in sorted({to_month(month) for month in months}):
        condition |= F.col("date").between(F.lit(first), F.last_day(F.lit(first)))
    return partials.filter(condition)


def daily_coverage_problems(
    partials: DataFrame, months: Sequence[str | dt.date] | None = None
) -> DataFrame:
    """Days with no trips, else days with implausibly few, per month.

    Low days (under a share of the exact median of the month's days) are reported only
    for a month in which every day is present.  ``months`` adds months that must be
    covered even if they have no rows at all.
    """
    per_month = (
        partials.groupBy("date")
        .agg(F.sum("ride_count").alias("ride_count"))
        .groupBy(F.trunc("date", "month").alias("first_day"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct("date", "ride_count"))).alias("by_day"),
            F.median("ride_count").alias("median_day"),
            F.count("*").alias("days_present"),
        )
    )
    if months is not None:
        starts = sorted({to_month(month) for month in months})
        wanted = partials.sparkSession.createDataFrame(
            [(start,) for start in starts], "first_day date"
        )
        per_month = wanted.join(per_month, "first_day", "left")
    days = per_month.withColumn(
        "date", F.explode(F.sequence(F.col("first_day"), F.last_day("first_day")))
    ).withColumn("ride_count", F.try_element_at("by_day", "date"))
    complete = F.col("days_present") == F.dayofmonth(F.last_day("first_day"))
    low = complete & (F.col("ride_count") < F.lit(S.LOW_DAY_SHARE_OF_MEDIAN) * F.col("median_day"))
    problem = F.when(F.col("ride_count").isNull(), "missing").when(low, "low")
    return days.select(
        month_text("first_day").alias("month"),
        "date",
        problem.alias("problem"),
        F.coalesce("ride_count", F.lit(0)).alias("ride_count"),
    ).filter(F.col("problem").isNotNull())


def covered_months(partials: DataFrame) -> DataFrame:
    """Partials of the months that have no coverage problem."""
    gaps = daily_coverage_problems(partials).select("month").distinct()
    named = partials.withColumn("_month", month_text(F.trunc("date", "month")))
    return named.join(gaps.withColumnRenamed("month", "_month"), "_month", "left_anti").drop("_month")


class CoverageError(ValueError):
    """A month has unreported days."""


def assert_daily_coverage(partials: DataFrame, months: Sequence[str | dt.date]) -> None:
    """Raise if any of the months has a coverage problem."""
    # The first month with problems is named; it has at most 31 days.
    rows = daily_coverage_problems(partials, months).orderBy("date").take(31)
    if not rows:
        return
    rows = [row for row in rows if row["month"] == rows[0]["month"]]
    found = "; ".join(
        f"{row['date']}" + (f" ({row['ride_count']})" if row["problem"] == "low" else "")
        for row in rows
    )
    kind = "no trips" if rows[0]["problem"] == "missing" else "implausibly few trips"
    raise CoverageError(f"{rows[0]['month']} has {kind} on: {found}")
