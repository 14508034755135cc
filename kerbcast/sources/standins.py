"""Trip-shaped views of the benchmark tables.

The generated tables hold no taxi trips.  These adapters derive the published trip
schema from them row by row, so every job downstream works on whole tables:

* ``event_trips``: one month with true times of day, from ``events``;
* ``order_trips``: eighty months, from ``orders``, for windows and backtests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_MONTH = "2024-01"
ORDER_FIRST_MONTH, ORDER_MONTHS = "1995-01", 80
N_LOCATIONS = 65


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trips(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None
) -> DataFrame:
    """Trips from ``events``, or from a stream of the same columns."""
    source = table(spark, sf_dir, "events") if events is None else events
    # Generated rather than projected, so that filters above reuse the parsed number
    # instead of parsing the text again in every condition.
    events = source.withColumn("k", F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))))
    quiet = F.col("event_type").isin("view", "signup") & (F.col("k") % 25 == 0)
    voided = (F.col("event_type") == "error") & (F.col("k") % 10 == 0)
    return events.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        F.when(F.col("k") % 50 != 49, F.col("ts") + F.make_dt_interval(mins=F.col("k"))).alias(
            "tpep_dropoff_datetime"
        ),
        (F.col("user_id") % 60 + 1).cast("int").alias("PULocationID"),
        ((F.col("user_id") * 7 + F.col("k")) % N_LOCATIONS + 1).cast("int").alias("DOLocationID"),
        F.when(quiet, F.lit(0.0)).otherwise(F.round(F.col("value") / 5, 2)).alias("trip_distance"),
        F.when(F.col("k") == 77, F.lit(None))
        .when(voided, -F.col("value"))
        .otherwise(F.col("value"))
        .alias("fare_amount"),
        "event_id",
        "event_type",
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    pickup = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    minutes = (F.col("o_orderkey") % 37 + 4).cast("int")
    return orders.select(
        pickup.alias("tpep_pickup_datetime"),
        (pickup + F.make_dt_interval(mins=minutes)).alias("tpep_dropoff_datetime"),
        (F.col("o_custkey") % 60 + 1).cast("int").alias("PULocationID"),
        (F.col("o_orderkey") % N_LOCATIONS + 1).cast("int").alias("DOLocationID"),
        (F.floor(F.col("o_totalprice") / 1000) / 50).alias("trip_distance"),
        (F.col("o_totalprice") / 1000).alias("fare_amount"),
        "o_orderkey",
    )


def lattice_centroids(spark: SparkSession) -> DataFrame:
    """Centre points by rule: ids 1..65 on a lattice, every 13th id unmapped."""
    n = F.col("location_id") - 1
    return (
        spark.range(1, N_LOCATIONS + 1, 1, 1)
        .select(F.col("id").cast("int").alias("location_id"))
        .filter(F.col("location_id") % 13 != 0)
        .select(
            "location_id",
            F.format_string("Zone %d", "location_id").alias("zone"),
            F.format_string("Borough %d", (n % 6).cast("int")).alias("borough"),
            (F.lit(40.55) + F.lit(0.06) * (n % 6)).alias("lat"),
            (F.lit(-74.15) + F.lit(0.035) * F.floor(n / 6)).alias("lng"),
        )
    )
