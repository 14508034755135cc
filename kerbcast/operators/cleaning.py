"""Trip cleaning.

Two questions are kept apart.  *Is this a pickup to count?* decides which rows stay.
*Can its measurements be trusted?* only blanks values.  A comparison with a missing value
never rejects a row, so every rejecting condition is read as false when it is NULL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.clock import minutes_between, shift_month, to_month
from kerbcast.operators.lookups import lookup_join

CLEAN_COLUMNS = (
    "start_time",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
    "ride_duration_min",
    "ride_distance_km",
)


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def starts_in_period(trips: DataFrame, first_month: str | dt.date, n_months: int = 1) -> DataFrame:
    """Trips picked up in ``n_months`` calendar months from ``first_month``.

    Written as a half-open range on the bare column so that it reaches the file scan.
    """
    first = to_month(first_month)
    end = shift_month(first, n_months)
    column_type = trips.schema["start_time"].dataType.simpleString()
    low, high = (F.lit(f"{day} 00:00:00").cast(column_type) for day in (first, end))
    return trips.filter((F.col("start_time") >= low) & (F.col("start_time") < high))


def is_voided(fare: Column) -> Column:
    return _holds(fare < 0)


def is_false_start(start: Column, end: Column, miles: Column) -> Column:
    """Too short and without distance.  Compares timestamps, so that the filter does not
    compute the duration a second time."""
    shortest = F.make_dt_interval(mins=F.lit(S.MIN_DURATION_MIN))
    return _holds((end < start + shortest) & (miles == 0))


def is_too_fast(minutes: Column, miles: Column) -> Column:
    """Judged on raw values; undefined, hence false, without a positive duration."""
    hours = F.when(minutes > 0, minutes) / 60
    return _holds(miles / hours > S.MAX_SPEED_MPH)


def with_raw_minutes(trips: DataFrame) -> DataFrame:
    return trips.withColumn("_minutes", minutes_between(F.col("start_time"), F.col("end_time")))


def drop_uncountable(trips: DataFrame) -> DataFrame:
    """Drop voided records and false starts."""
    false_start = is_false_start(
        F.col("start_time"), F.col("end_time"), F.col("trip_distance_miles")
    )
    return trips.filter(~is_voided(F.col("fare_amount"))).filter(~false_start)


def trusted_measurements(trips: DataFrame) -> DataFrame:
    """Add duration and distance, blank where implausible (needs ``_minutes``)."""
    minutes, miles = F.col("_minutes"), F.col("trip_distance_miles")
    too_fast = is_too_fast(minutes, miles)
    minutes_ok = minutes.between(S.MIN_DURATION_MIN, S.MAX_DURATION_MIN)
    miles_ok = miles.between(S.MIN_DISTANCE_MILES, S.MAX_DISTANCE_MILES)
    return trips.withColumns(
        {
            "ride_duration_min": F.when(minutes_ok & ~too_fast, minutes),
            "ride_distance_km": F.when(miles_ok & ~too_fast, miles * S.KM_PER_MILE),
        }
    )


def measure_trips(
    trips: DataFrame,
    first_month: str | dt.date,
    n_months: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All cleaning that needs no lookup: a narrow map over the scan."""
    counted = drop_uncountable(starts_in_period(trips, first_month, n_months))
    return trusted_measurements(with_raw_minutes(counted)).select(*CLEAN_COLUMNS, *keep)


def with_coordinates(trips: DataFrame, centroids: DataFrame) -> DataFrame:
    """Replace location ids by centre points.

    An unmapped pickup drops the row, an unmapped dropoff leaves its coordinates empty.
    """

    def points(prefix: str, key: str) -> DataFrame:
        return centroids.select(
            F.col("location_id").alias(key),
            F.col("lat").alias(f"{prefix}_lat"),
            F.col("lng").alias(f"{prefix}_lng"),
        )

    located = lookup_join(
        trips, points("start", "pickup_location_id"), "pickup_location_id", "inner"
    )
    return lookup_join(
        located, points("end", "dropoff_location_id"), "dropoff_location_id", "left"
    )


def clean_trips(
    trips: DataFrame,
    first_month: str | dt.date,
    centroids: DataFrame,
    n_months: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cleaned, located trips.  Unordered; see ``in_start_order`` for output."""
    measured = measure_trips(trips, first_month, n_months, keep)
    coordinates = ("start_lat", "start_lng", "end_lat", "end_lng")
    return with_coordinates(measured, centroids).select(*CLEAN_COLUMNS, *coordinates, *keep)


def in_start_order(trips: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Range-partitioned sort for final output; nothing downstream depends on order."""
    return trips.orderBy("start_time", *tiebreak)
