"""Landing, checking, publishing and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import ev_raw, scratch
from catalog.section import Section
from catalog.sql import exact_sum, with_
from kerbcast.functions.clock import month_of, month_text
from kerbcast.operators import cleaning as C
from kerbcast.operators.periods import calendar, months_present
from kerbcast.sources import ingest
from kerbcast.sources.centroids import read_centroids, write_centroids
from kerbcast.sources.standins import event_trips, order_trips, table
from kerbcast.sources.trips import normalize_trips, scan_trips
from kerbcast.streaming.demand import current_partials, run_hourly_partials
from kerbcast.streaming.ingest import ingest_stream

register = Section()


def _land(spark, sf_dir, path):
    """Every year of the order trips as landed months (one folder per year's January)."""
    trips = order_trips(spark, sf_dir)
    month = F.date_format(F.trunc(F.col("tpep_pickup_datetime").cast("date"), "year"), "yyyy-MM")
    landed = trips.withColumn("month", month).repartition("month")
    landed.write.partitionBy("month").parquet(path)


def _land_months(spark, sf_dir, path):
    """The order trips in a folder for each of their months."""
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    landed = order_trips(spark, sf_dir).withColumn("month", month).repartition("month")
    landed.write.partitionBy("month").parquet(path)


@register(
    "a3_a11_centroid_csv",
    """SELECT CAST(s_suppkey AS INTEGER) AS location_id, s_name AS zone, n_name AS borough,
      40.5::DOUBLE + s_acctbal / 100000 AS lat, -74.0::DOUBLE + s_suppkey / 1000 AS lng
      FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
)
def a3(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    centroids = supplier.join(nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("s_suppkey").cast("int").alias("location_id"),
        F.col("s_name").alias("zone"),
        F.col("n_name").alias("borough"),
        (F.lit(40.5) + F.col("s_acctbal") / 100000).alias("lat"),
        (F.lit(-74.0) + F.col("s_suppkey") / 1000).alias("lng"),
    )
    path = scratch(spark)
    write_centroids(centroids, path)
    return read_centroids(spark, path)


@register(
    "a4_months_of_table",
    "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
)
def a4(spark, sf_dir):
    path = scratch(spark)
    _land_months(spark, sf_dir, path)
    return ingest.available_months(spark, path)


@register(
    "a5_month_pruned_scan",
    with_("or_raw") + """SELECT o_orderkey, start_time, end_time, pickup_location_id,
      dropoff_location_id, miles AS trip_distance_miles, fare_amount FROM or_raw
      WHERE strftime(start_time, '%Y-%m') IN ('1997-01', '1997-02', '1999-11')""",
)
def a5(spark, sf_dir):
    path = scratch(spark)
    _land_months(spark, sf_dir, path)
    return scan_trips(spark, path, ["1997-01", "1997-02", "1999-11"], keep=["o_orderkey"])


@register(
    "a6_ingest_status",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus
        FROM orders)
      SELECT strftime(w.month, '%Y-%m') AS month, CASE
        WHEN w.month IN (SELECT month FROM m WHERE month < DATE '1999-06-01') THEN 'already_present'
        WHEN w.month IN (SELECT month FROM m) THEN 'downloaded' ELSE 'not_published' END AS status
      FROM (SELECT CAST(unnest(generate_series(DATE '1994-06-01', DATE '2002-06-01', INTERVAL 1 MONTH))
        AS DATE) AS month) w""",
)
def a6(spark, sf_dir):
    landed = months_present(table(spark, sf_dir, "orders"), "o_orderdate")
    present = landed.filter(F.col("month") < F.lit("1999-06-01").cast("date"))
    status = ingest.ingest_status(calendar(spark, "1994-06", "2002-06"), present, landed)
    return ingest.status_text(status)


@register(
    "a7_h4_contract_violations",
    """SELECT * FROM (VALUES ('lost', 'missing_column', 'fare_amount'),
      ('lost', 'missing_column', 'trip_distance'), ('mixed', 'missing_column', 'fare_amount'),
      ('typed', 'wrong_type', 'PULocationID')) v(file, rule, column_name)""",
)
def a7(spark, sf_dir):
    """Landed files of the event trips: whole ones yield nothing, broken ones their faults,
    also where only the second file of a month is broken."""
    trips = event_trips(spark, sf_dir)
    broken = {
        "whole": trips,
        "mixed": trips,
        "lost": trips.drop("fare_amount", "trip_distance"),
        "typed": trips.withColumn("PULocationID", F.col("PULocationID").cast("string")),
    }
    root = scratch(spark)
    found = None
    for name, df in broken.items():
        df.write.parquet(f"{root}/{name}")
        if name == "mixed":
            trips.drop("fare_amount").coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        rows = ingest.contract_violations(spark, f"{root}/{name}").withColumn("file", F.lit(name))
        found = rows if found is None else found.unionByName(rows)
    return found.select("file", "rule", "column_name")


PUBLISHED = """SELECT strftime(date_trunc('year', o_orderdate), '%Y-%m') AS month, count(*) AS trips
  FROM orders GROUP BY ALL"""


@register("a8_published_months", PUBLISHED)
def a8(spark, sf_dir):
    landing, curated = scratch(spark), scratch(spark)
    _land(spark, sf_dir, landing)
    # Twice: the second run finds every month present.
    for _ in range(2):
        ingest.ingest_months(spark, landing, curated, "1994-01", "2002-12")
    months = ingest.read_table(spark, curated).groupBy(F.col("month").cast("string").alias("month"))
    return months.agg(F.count("*").alias("trips"))


@register("k1_stream_ingest", PUBLISHED)
def k1(spark, sf_dir):
    landing, curated, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    _land(spark, sf_dir, landing)
    for _ in range(2):
        ingest_stream(spark, landing, curated, checkpoint).awaitTermination()
    months = ingest.read_table(spark, curated).groupBy(F.col("month").cast("string").alias("month"))
    return months.agg(F.count("*").alias("trips"))


@register(
    "k2_stream_hourly_partials",
    with_("ev_measured") + """SELECT pickup_location_id, CAST(start_time AS DATE) AS date,
      CAST(hour(start_time) AS INTEGER) AS hour, count(*) AS ride_count,
      coalesce(""" + exact_sum("ride_duration_min", "6e7") + """, 0) AS duration_sum,
      coalesce(""" + exact_sum("ride_distance_km", "1e6") + """, 0) AS distance_sum,
      count(ride_duration_min) AS duration_n, count(ride_distance_km) AS distance_n
      FROM ev_measured GROUP BY ALL""",
)
def k2(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    trips = normalize_trips(event_trips(spark, sf_dir, stream))
    out, checkpoint = scratch(spark), scratch(spark)
    run_hourly_partials(C.measure_trips(trips, "2024-01"), out, checkpoint).awaitTermination()
    return current_partials(spark, out)


@register(
    "a2_months_of_trips",
    with_("ev_raw") + """SELECT strftime(start_time, '%Y-%m') AS month, count(*) AS trips
      FROM ev_raw GROUP BY ALL""",
)
def a2_months(spark, sf_dir):
    months = ev_raw(spark, sf_dir).groupBy(month_text(month_of("start_time")).alias("month"))
    return months.agg(F.count("*").alias("trips"))
