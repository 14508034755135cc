"""Batch scoring of prediction requests.

A request names an hour, optionally a date, and either a zone or a point.  Requests are a
table: rules split it into valid and rejected rows, and everything else is joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast import settings as S
from kerbcast.functions.clock import day_of_week, local_today
from kerbcast.functions.geo import nearest_centre
from kerbcast.operators.grid import HOURS
from kerbcast.operators.lookups import lookup_join
from kerbcast.plans.forecast import Bundle, Fitted, Zoning


def invalid_reason(n_zones: int) -> Column:
    """The first rule a request breaks, NULL if it is valid."""
    has_zone = F.col("pickup_zone").isNotNull()
    has_lat, has_lng = F.col("lat").isNotNull(), F.col("lng").isNotNull()
    has_point = has_lat & has_lng
    hour_ok = F.coalesce(F.col("hour").between(0, HOURS - 1), F.lit(False))
    return (
        F.when(~hour_ok, "hour must be 0 to 23")
        .when(has_zone == has_point, "give exactly one of pickup_zone or lat and lng")
        .when(has_lat != has_lng, "lat and lng must be given together")
        .when(has_point & ~F.col("lat").between(S.LAT_MIN, S.LAT_MAX), "lat outside the service area")
        .when(has_point & ~F.col("lng").between(S.LNG_MIN, S.LNG_MAX), "lng outside the service area")
        .when(has_zone & ~F.col("pickup_zone").between(0, n_zones - 1), "unknown pickup_zone")
    )


def checked_requests(requests: DataFrame, n_zones: int) -> DataFrame:
    return requests.withColumn("invalid_reason", invalid_reason(n_zones))


def split_requests(requests: DataFrame, n_zones: int) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``invalid_reason``)."""
    checked = checked_requests(requests, n_zones)
    valid = checked.filter(F.col("invalid_reason").isNull()).drop("invalid_reason")
    return valid, checked.filter(F.col("invalid_reason").isNotNull())


def resolve_requests(valid: DataFrame, centres, as_of: Column) -> DataFrame:
    """Fill in the zone of a point and today's date in the service time zone."""
    nearest = nearest_centre(F.col("lat"), F.col("lng"), centres)["zone"]
    today = local_today(as_of, S.SERVICE_TIME_ZONE)
    return valid.withColumns(
        {
            "pickup_zone": F.coalesce("pickup_zone", nearest),
            "date": F.coalesce("date", today),
        }
    )


def request_features(resolved: DataFrame, profile: DataFrame) -> DataFrame:
    """Features of resolved requests; a zone-hour without a profile gets zeros."""
    joined = lookup_join(resolved, profile, ["pickup_zone", "hour"], "left")
    return joined.withColumns(
        {
            "day_of_week": day_of_week("date"),
            "avg_ride_duration_min": F.coalesce("avg_ride_duration_min", F.lit(0.0)),
            "avg_ride_distance": F.coalesce("avg_ride_distance", F.lit(0.0)),
        }
    )


def predict_requests(
    requests: DataFrame, zoning: Zoning, fitted: Fitted, as_of: Column, keep: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(predictions, rejected requests).  ``keep`` names columns to carry along."""
    valid, rejected = split_requests(requests, zoning.n_zones)
    resolved = resolve_requests(valid, zoning.centres, as_of)
    scored = fitted.predict(request_features(resolved, zoning.profile))
    predictions = scored.select(
        *keep,
        "pickup_zone",
        "hour",
        "date",
        F.col("prediction").alias("predicted_avg_daily_ride_count"),
    )
    return predictions, rejected


def with_rank(predictions: DataFrame, value: str = "predicted_avg_daily_ride_count") -> DataFrame:
    """Rank of zones within each date and hour; ties keep zone order.

    Each group holds one row per zone.
    """
    order = Window.partitionBy("date", "hour").orderBy(F.desc(value), "pickup_zone")
    return predictions.withColumn("rank", F.row_number().over(order))


def top_zones(predictions: DataFrame, top_n: int | None = None) -> DataFrame:
    """The ``top_n`` busiest zones of each date and hour; all of them if not given."""
    if top_n is not None and top_n < 1:
        raise ValueError("top_n must be at least 1")
    ranked = with_rank(predictions)
    return ranked if top_n is None else ranked.filter(F.col("rank") <= top_n)


def rankings(
    moments: DataFrame, zoning: Zoning, fitted: Fitted, as_of: Column, top_n: int | None = None
) -> DataFrame:
    """Zones ranked for each requested ``date, hour`` (today where the date is missing)."""
    today = local_today(as_of, S.SERVICE_TIME_ZONE)
    asked = (
        moments.withColumn("date", F.coalesce("date", today))
        .filter(F.col("hour").between(0, HOURS - 1))
        .select("date", "hour")
        .distinct()
        .withColumn("pickup_zone", F.explode(F.sequence(F.lit(0), F.lit(zoning.n_zones - 1))))
    )
    scored = fitted.predict(request_features(asked, zoning.profile))
    predictions = scored.select(
        "date", "hour", "pickup_zone", F.col("prediction").alias("predicted_avg_daily_ride_count")
    )
    return top_zones(predictions, top_n)


def model_age(bundles: DataFrame, as_of: Column) -> DataFrame:
    """Age in days of each ``trained_at TIMESTAMP`` and whether it is stale."""
    micros = F.unix_micros(as_of) - F.unix_micros("trained_at")
    age = micros / F.lit(86_400_000_000.0)
    return bundles.withColumns({"age_days": age, "is_stale": age > S.STALE_AFTER_DAYS})


def predict_with_bundle(requests: DataFrame, bundle: Bundle, as_of: Column, keep: list[str]):
    """Score requests with a loaded bundle."""
    return predict_requests(requests, bundle.zoning, bundle.fitted, as_of, keep)
