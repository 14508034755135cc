import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbcast.session import build_session, ensure_checkpoint_dir


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


RAW = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "PULocationID int, DOLocationID int, trip_distance double, fare_amount double"
)
PARTIALS = (
    "pickup_location_id int, date date, hour int, ride_count bigint, duration_sum double, "
    "duration_n bigint, distance_sum double, distance_n bigint"
)


@pytest.fixture(scope="session")
def make_raw(spark):
    """Raw trips from (pickup text, minutes or None, miles, pickup, dropoff, fare)."""

    def build(rows):
        table = []
        for start, minutes, miles, pickup, dropoff, fare in rows:
            begin = dt.datetime.fromisoformat(start)
            end = None if minutes is None else begin + dt.timedelta(minutes=minutes)
            table.append((begin, end, pickup, dropoff, miles, fare))
        return spark.createDataFrame(table, RAW)

    return build


@pytest.fixture(scope="session")
def make_partials(spark):
    def build(rows):
        table = [(loc, dt.date.fromisoformat(day), *rest) for loc, day, *rest in rows]
        return spark.createDataFrame(table, PARTIALS)

    return build


@pytest.fixture(scope="session")
def grid_centroids(spark):
    """Thirty places on three circles around a point of the service area."""
    turn = F.col("location_id") * 2.399963
    reach = F.lit(0.03) + F.col("location_id") % 3 * 0.05
    return spark.range(1, 31, 1, 1).select(
        F.col("id").cast("int").alias("location_id"),
        F.format_string("Place %d", "id").alias("zone"),
        F.lit("Here").alias("borough"),
    ).select(
        "*",
        (F.lit(40.68) + reach * F.sin(turn)).alias("lat"),
        (F.lit(-73.96) + reach * F.cos(turn)).alias("lng"),
    )


@pytest.fixture(scope="session")
def month_trips(spark):
    """Raw trips of whole months: every day covered, low ids busier, two weekdays busier by
    half."""

    def build(first, days, per_day=60):
        start = dt.date.fromisoformat(first)
        hashed = F.xxhash64("day", "n")
        busy = F.weekday("day").isin(1, 4)
        slots = F.sequence(F.lit(1), F.when(busy, per_day * 3 // 2).otherwise(per_day))
        rows = (
            spark.range(days)
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
            .withColumn("n", F.explode(slots))
            .withColumn("h", F.pmod(hashed, F.lit(1_000_003)))
        )
        second = (F.col("h") * 7919) % 86400
        begin = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(secs=second.cast("decimal(18,6)"))
        place = (F.floor(F.pow(F.lit(31.0), (F.col("h") % 997) / 997))).cast("int")
        return rows.select(
            begin.alias("tpep_pickup_datetime"),
            (begin + F.make_dt_interval(mins=(F.col("h") % 35 + 5).cast("int"))).alias(
                "tpep_dropoff_datetime"
            ),
            F.least(place, F.lit(30)).alias("PULocationID"),
            (F.col("h") % 30 + 1).cast("int").alias("DOLocationID"),
            (F.lit(0.5) + (F.col("h") % 16) / 10).alias("trip_distance"),
            (F.lit(5.0) + F.col("h") % 55).alias("fare_amount"),
        )

    return build
