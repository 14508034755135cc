"""Scans, cleaning rules, scalar functions and location joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import ev_clean, ev_measured, ev_partials, ev_raw, or_partials
from catalog.section import Section
from catalog.sql import with_
from kerbcast import settings as S
from kerbcast.functions.clock import day_of_week
from kerbcast.functions.geo import in_service_area
from kerbcast.operators import cleaning as C
from kerbcast.operators.partials import location_hour_daily
from kerbcast.sources.standins import event_trips, order_trips
from kerbcast.sources.trips import normalize_trips

register = Section()

RAW = "event_id, start_time, end_time, pickup_location_id, dropoff_location_id"


@register(
    "a1_trip_scan",
    with_("ev_raw") + f"SELECT {RAW}, miles AS trip_distance_miles, fare_amount FROM ev_raw",
)
def a1(spark, sf_dir):
    return ev_raw(spark, sf_dir)


@register(
    "a2_number_normalization",
    with_("ev_raw") + """SELECT event_id,
      CASE WHEN event_id % 9 <> 0 THEN miles END AS trip_distance_miles, fare_amount FROM ev_raw""",
)
def a2(spark, sf_dir):
    # Distances arrive as text here, with not-a-number for every ninth trip.
    raw = event_trips(spark, sf_dir).withColumn(
        "trip_distance",
        F.when(F.col("event_id") % 9 == 0, F.lit("NaN")).otherwise(
            F.col("trip_distance").cast("string")
        ),
    )
    numbers = normalize_trips(raw, keep=["event_id"])
    return numbers.select("event_id", "trip_distance_miles", "fare_amount")


@register(
    "b1_starts_in_month",
    with_("or_raw") + """SELECT o_orderkey, start_time FROM or_raw
      WHERE start_time >= TIMESTAMP '1998-03-01' AND start_time < TIMESTAMP '1998-04-01'""",
)
def b1(spark, sf_dir):
    trips = normalize_trips(order_trips(spark, sf_dir), keep=["o_orderkey"])
    return C.starts_in_period(trips, "1998-03").select("o_orderkey", "start_time")


@register(
    "b2_drop_voided",
    with_("ev_raw") + "SELECT event_id, fare_amount FROM ev_raw WHERE coalesce(fare_amount >= 0, true)",
)
def b2(spark, sf_dir):
    trips = ev_raw(spark, sf_dir)
    return trips.filter(~C.is_voided(F.col("fare_amount"))).select("event_id", "fare_amount")


@register(
    "b3_drop_false_starts",
    with_("ev_raw") + """SELECT event_id, (epoch_us(end_time) - epoch_us(start_time)) / 6e7 AS minutes,
      miles FROM ev_raw WHERE end_time IS NULL OR miles IS NULL
        OR NOT (epoch_us(end_time) - epoch_us(start_time) < 60000000 AND miles = 0)""",
)
def b3(spark, sf_dir):
    trips = C.with_raw_minutes(ev_raw(spark, sf_dir))
    false_start = C.is_false_start(
        F.col("start_time"), F.col("end_time"), F.col("trip_distance_miles")
    )
    kept = trips.filter(~false_start)
    return kept.select(
        "event_id", F.col("_minutes").alias("minutes"), F.col("trip_distance_miles").alias("miles")
    )


@register(
    "b4_d1_pickup_centroid_join",
    with_("ev_measured", "centroids") + """SELECT event_id, pickup_location_id, lat AS start_lat,
      lng AS start_lng FROM ev_measured JOIN centroids ON location_id = pickup_location_id""",
)
def b4(spark, sf_dir):
    return ev_clean(spark, sf_dir).select(
        "event_id", "pickup_location_id", "start_lat", "start_lng"
    )


@register(
    "b5_service_area_box",
    with_("ev_clean") + """SELECT event_id, end_lat, end_lng,
      coalesce(end_lat BETWEEN 40.4766::DOUBLE AND 40.9176::DOUBLE
        AND end_lng BETWEEN -74.2588::DOUBLE AND -73.7002::DOUBLE, false) AS inside FROM ev_clean""",
)
def b5(spark, sf_dir):
    inside = F.coalesce(in_service_area(F.col("end_lat"), F.col("end_lng")), F.lit(False))
    return ev_clean(spark, sf_dir).select("event_id", "end_lat", "end_lng", inside.alias("inside"))


@register(
    "c1_c2_minutes_and_km",
    with_("ev_raw") + """SELECT event_id, (epoch_us(end_time) - epoch_us(start_time)) / 6e7 AS minutes,
      miles * 1.609344::DOUBLE AS km FROM ev_raw""",
)
def c1(spark, sf_dir):
    return C.with_raw_minutes(ev_raw(spark, sf_dir)).select(
        "event_id",
        F.col("_minutes").alias("minutes"),
        (F.col("trip_distance_miles") * S.KM_PER_MILE).alias("km"),
    )


@register(
    "c3_too_fast",
    with_("ev_raw") + """SELECT event_id, coalesce(miles / (CASE WHEN minutes > 0 THEN minutes END / 60)
        > 70, false) AS too_fast
      FROM (SELECT *, (epoch_us(end_time) - epoch_us(start_time)) / 6e7 AS minutes FROM ev_raw)""",
)
def c3(spark, sf_dir):
    trips = C.with_raw_minutes(ev_raw(spark, sf_dir))
    fast = C.is_too_fast(F.col("_minutes"), F.col("trip_distance_miles"))
    return trips.select("event_id", fast.alias("too_fast"))


@register(
    "c4_trusted_measurements",
    with_("ev_measured") + "SELECT event_id, ride_duration_min, ride_distance_km FROM ev_measured",
)
def c4(spark, sf_dir):
    return ev_measured(spark, sf_dir).select("event_id", "ride_duration_min", "ride_distance_km")


@register(
    "c5_c6_date_hour_weekday",
    with_("ev_measured") + """SELECT event_id, CAST(start_time AS DATE) AS date,
      CAST(hour(start_time) AS INTEGER) AS hour,
      CAST(isodow(start_time) - 1 AS INTEGER) AS day_of_week FROM ev_measured""",
)
def c5(spark, sf_dir):
    return ev_measured(spark, sf_dir).select(
        "event_id",
        F.col("start_time").cast("date").alias("date"),
        F.hour("start_time").alias("hour"),
        day_of_week(F.col("start_time").cast("date")).alias("day_of_week"),
    )


CLEAN = """start_time, pickup_location_id, dropoff_location_id, fare_amount,
  ride_duration_min, ride_distance_km, start_lat, start_lng, end_lat, end_lng"""


@register(
    "d2_dropoff_centroid_join",
    with_("ev_clean") + "SELECT event_id, dropoff_location_id, end_lat, end_lng FROM ev_clean",
)
def d2(spark, sf_dir):
    return ev_clean(spark, sf_dir).select("event_id", "dropoff_location_id", "end_lat", "end_lng")


@register("g1_clean_trips_by_start", with_("ev_clean") + f"SELECT event_id, {CLEAN} FROM ev_clean")
def g1(spark, sf_dir):
    return C.in_start_order(ev_clean(spark, sf_dir), tiebreak=["event_id"])


@register("e4_location_hour_day", with_("ev_partials") + "SELECT * FROM ev_partials")
def e4(spark, sf_dir):
    return ev_partials(spark, sf_dir)


@register("e4_location_hour_day_orders", with_("or_partials") + "SELECT * FROM or_partials")
def e4_orders(spark, sf_dir):
    return or_partials(spark, sf_dir)


@register("e4_from_clean_trips", with_("ev_partials") + "SELECT * FROM ev_partials")
def e4_clean(spark, sf_dir):
    return location_hour_daily(ev_clean(spark, sf_dir))
