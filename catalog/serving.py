"""Requests, rankings, model age and scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.common import ev_daily, ev_partials, ev_zoning, scratch
from catalog.section import Section
from catalog.sql import CENTRES, N_ZONES, block, metrics, nearest, with_
from kerbcast.functions.clock import local_today
from kerbcast.operators.baselines import zone_hour_weekday_mean
from kerbcast.plans import serving
from kerbcast.plans.bundles import bundle_files, load_bundle, save_bundle
from kerbcast.plans.forecast import BoostedTrees, Bundle, WeekdayMean, feature_rows
from kerbcast.plans.lifecycle import score_bundle
from kerbcast.settings import SERVICE_TIME_ZONE
from kerbcast.sources.standins import lattice_centroids, table

register = Section()

# "Now" for every request: an instant given as a UTC reading.
AS_OF = "2024-02-02 03:30:00"

# --- requests from events ------------------------------------------------------------

block(
    "requests",
    sql="""SELECT event_id, CAST(k % 25 AS INTEGER) AS hour,
      CASE WHEN k % 7 <> 0 THEN CAST(ts AS DATE) END AS date,
      CASE WHEN k % 3 = 0 OR k % 13 = 0 THEN CAST(user_id % 21 AS INTEGER) END AS pickup_zone,
      CASE WHEN k % 3 > 0 AND k % 11 <> 1 THEN 40.47::DOUBLE + 0.005::DOUBLE * k END AS lat,
      CASE WHEN k % 3 > 0 AND k % 17 <> 2 THEN -74.27::DOUBLE + 0.006::DOUBLE * (user_id % 97) END AS lng
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
)
_REASON = f"""CASE
  WHEN NOT coalesce(hour BETWEEN 0 AND 23, false) THEN 'hour must be 0 to 23'
  WHEN (pickup_zone IS NOT NULL) = (lat IS NOT NULL AND lng IS NOT NULL)
    THEN 'give exactly one of pickup_zone or lat and lng'
  WHEN (lat IS NULL) <> (lng IS NULL) THEN 'lat and lng must be given together'
  WHEN lat IS NOT NULL AND lng IS NOT NULL AND NOT lat BETWEEN 40.4766::DOUBLE AND 40.9176::DOUBLE
    THEN 'lat outside the service area'
  WHEN lat IS NOT NULL AND lng IS NOT NULL AND NOT lng BETWEEN -74.2588::DOUBLE AND -73.7002::DOUBLE
    THEN 'lng outside the service area'
  WHEN pickup_zone IS NOT NULL AND NOT pickup_zone BETWEEN 0 AND {N_ZONES - 1}
    THEN 'unknown pickup_zone' END"""
block("checked", "requests", sql=f"SELECT *, {_REASON} AS invalid_reason FROM requests")
block(
    "resolved", "checked",
    sql=f"""SELECT event_id, hour, coalesce(date, DATE '2024-02-01') AS date,
      coalesce(pickup_zone, CAST({nearest('lat', 'lng', CENTRES)} AS INTEGER)) AS pickup_zone
      FROM checked WHERE invalid_reason IS NULL""",
)


def _requests(spark, sf_dir):
    k, user = F.col("k"), F.col("user_id")
    number = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").withColumn("k", F.explode(F.array(number)))
    return events.select(
        "event_id",
        (k % 25).alias("hour"),
        F.when(k % 7 != 0, F.col("ts").cast("date")).alias("date"),
        F.when((k % 3 == 0) | (k % 13 == 0), (user % 21).cast("int")).alias("pickup_zone"),
        F.when((k % 3 > 0) & (k % 11 != 1), F.lit(40.47) + F.lit(0.005) * k).alias("lat"),
        F.when((k % 3 > 0) & (k % 17 != 2), F.lit(-74.27) + F.lit(0.006) * (user % 97)).alias("lng"),
    )


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@register("b6_b7_b8_checked_requests", with_("checked") + "SELECT * FROM checked")
def b6(spark, sf_dir):
    return serving.checked_requests(_requests(spark, sf_dir), N_ZONES)


@register(
    "b8_rejected_by_reason",
    with_("checked") + """SELECT invalid_reason, count(*) AS n FROM checked
      WHERE invalid_reason IS NOT NULL GROUP BY ALL""",
)
def b8(spark, sf_dir):
    _, rejected = serving.split_requests(_requests(spark, sf_dir), N_ZONES)
    return rejected.groupBy("invalid_reason").agg(F.count("*").alias("n"))


@register("c12_i13_resolved_requests", with_("resolved") + "SELECT * FROM resolved")
def c12(spark, sf_dir):
    valid, _ = serving.split_requests(_requests(spark, sf_dir), N_ZONES)
    resolved = serving.resolve_requests(valid, CENTRES, _as_of())
    return resolved.select("event_id", "hour", "date", "pickup_zone")


@register(
    "c12_local_date",
    """SELECT event_id, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS local_date
      FROM events""",
)
def c12_local(spark, sf_dir):
    today = local_today(F.col("ts"), SERVICE_TIME_ZONE)
    return table(spark, sf_dir, "events").select("event_id", today.alias("local_date"))


@register(
    "c11_model_age",
    """SELECT event_id, (epoch_us(TIMESTAMP '2024-02-02 03:30:00') - epoch_us(ts)) / 8.64e10 AS age_days,
      (epoch_us(TIMESTAMP '2024-02-02 03:30:00') - epoch_us(ts)) / 8.64e10 > 30 AS is_stale
      FROM events""",
)
def c11(spark, sf_dir):
    trained = table(spark, sf_dir, "events").select(
        "event_id", F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).alias("at")
    )
    # Stored instants are TIMESTAMP; readings of the stand-in table are taken as UTC.
    bundles = trained.select("event_id", F.to_timestamp(F.col("at")).alias("trained_at"))
    aged = serving.model_age(bundles, F.lit(AS_OF + " UTC").cast("timestamp"))
    return aged.select("event_id", "age_days", "is_stale")


# --- predictions with the weekday mean -----------------------------------------------

block(
    "fitted", "ev_zhd",
    sql="""SELECT pickup_zone, hour, isodow(date) AS dow,
      CAST(sum(ride_count) AS DOUBLE) / count(*) AS prediction FROM ev_zhd GROUP BY ALL""",
)


def _bundle(spark, sf_dir):
    partials, zoning = ev_zoning(spark, sf_dir)
    fitted = WeekdayMean().fit(feature_rows(partials, zoning))
    metadata = {
        "metrics": {},
        "trained_at": "2024-02-01T00:00:00+00:00",
        "train_months": ["2024-01"],
        "eval_train_months": [],
        "test_month": None,
        "window_months": 1,
        "gap_months": 2,
        "n_zones": zoning.n_zones,
        "n_train_rows": 0,
        "n_test_rows": 0,
        "feature_order": [],
    }
    return Bundle(zoning, fitted, metadata)


PREDICTED = """SELECT event_id, pickup_zone, hour, date,
  prediction AS predicted_avg_daily_ride_count
  FROM (SELECT *, isodow(date) AS dow FROM resolved) JOIN fitted USING (pickup_zone, hour, dow)"""


@register("i12_i14_batch_predictions", with_("resolved", "fitted") + PREDICTED)
def i12(spark, sf_dir):
    bundle = _bundle(spark, sf_dir)
    predictions, _ = serving.predict_requests(
        _requests(spark, sf_dir), bundle.zoning, bundle.fitted, _as_of(), ["event_id"]
    )
    return predictions


@register("a12_predictions_from_saved_bundle", with_("resolved", "fitted") + PREDICTED)
def a12(spark, sf_dir):
    path = scratch(spark)
    save_bundle(spark, _bundle(spark, sf_dir), path)
    loaded = load_bundle(spark, path)
    predictions, _ = serving.predict_with_bundle(
        _requests(spark, sf_dir), loaded, _as_of(), ["event_id"]
    )
    return predictions


@register("a13_bundle_file_digests")
def a13(spark, sf_dir):
    path = scratch(spark)
    save_bundle(spark, _bundle(spark, sf_dir), path)
    return bundle_files(spark, path)


@register(
    "a13_digests_of_known_files",
    """SELECT 'o_orderpriority=' || o_orderpriority AS folder,
      sha256(string_agg(o_orderkey || ' ' || o_orderstatus, chr(10) ORDER BY o_orderkey) || chr(10)) AS sha256
      FROM orders GROUP BY o_orderpriority""",
)
def a13_known(spark, sf_dir):
    """One text file for each priority, whose bytes SQL can spell out."""
    line = F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("line")
    lines = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", line)
    path = scratch(spark)
    (
        lines.repartition("o_orderpriority")
        .sortWithinPartitions("o_orderpriority", "o_orderkey")
        .drop("o_orderkey")
        .write.partitionBy("o_orderpriority")
        .text(path)
    )
    files = bundle_files(spark, path)
    return files.select(F.url_decode(F.substring_index("file", "/", 1)).alias("folder"), "sha256")


@register(
    "i12_request_features",
    with_("resolved", "ev_profile") + """SELECT event_id, pickup_zone, hour, date,
      CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, avg_ride_duration_min, avg_ride_distance
      FROM resolved JOIN ev_profile USING (pickup_zone, hour)""",
)
def i12_features(spark, sf_dir):
    valid, _ = serving.split_requests(_requests(spark, sf_dir), N_ZONES)
    resolved = serving.resolve_requests(valid, CENTRES, _as_of())
    _, zoning = ev_zoning(spark, sf_dir)
    features = serving.request_features(resolved, zoning.profile)
    return features.drop("lat", "lng")


RANKED = """, ranked AS (SELECT date, hour, pickup_zone,
    prediction AS predicted_avg_daily_ride_count, CAST(row_number() OVER (PARTITION BY date, hour
      ORDER BY prediction DESC, pickup_zone) AS INTEGER) AS rank
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour FROM events) m
    JOIN fitted USING (hour) WHERE fitted.dow = isodow(m.date))"""


def _moments(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour")
    )


@register("f5_zone_rankings", with_("fitted") + RANKED + " SELECT * FROM ranked")
def f5(spark, sf_dir):
    bundle = _bundle(spark, sf_dir)
    moments = _moments(spark, sf_dir)
    return serving.rankings(moments, bundle.zoning, bundle.fitted, _as_of())


@register("g2_top_zones", with_("fitted") + RANKED + " SELECT * FROM ranked WHERE rank <= 5")
def g2(spark, sf_dir):
    bundle = _bundle(spark, sf_dir)
    moments = _moments(spark, sf_dir)
    return serving.rankings(moments, bundle.zoning, bundle.fitted, _as_of(), top_n=5)


@register(
    "g2_weekday_demand_ranking",
    with_("fitted") + """SELECT CAST(dow - 1 AS INTEGER) AS day_of_week, hour, pickup_zone,
      prediction AS predicted_avg_daily_ride_count, CAST(row_number() OVER (PARTITION BY dow, hour
      ORDER BY prediction DESC, pickup_zone) AS INTEGER) AS rank FROM fitted""",
)
def g2_weekday(spark, sf_dir):
    """Flagship: zones ranked by expected rides for every weekday and hour."""
    means = zone_hour_weekday_mean(ev_daily(spark, sf_dir), "predicted_avg_daily_ride_count")
    # Weekdays stand in for dates: the first week of the month holds each of them once.
    days = means.withColumn("date", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("day_of_week")))
    return serving.with_rank(days).drop("date")


@register(
    "i15_score_stored_model",
    with_("ev_zhd", "fitted") + f"""SELECT {metrics()} FROM
      (SELECT *, isodow(date) AS dow FROM ev_zhd) JOIN fitted USING (pickup_zone, hour, dow)""",
)
def i15(spark, sf_dir):
    path = scratch(spark)
    save_bundle(spark, _bundle(spark, sf_dir), path)
    return score_bundle(
        load_bundle(spark, path), ev_partials(spark, sf_dir), lattice_centroids(spark)
    )


@register("i12_i14_boosted_tree_predictions")
def i12_trees(spark, sf_dir):
    partials, zoning = ev_zoning(spark, sf_dir)
    params = {
        "n_estimators": 4,
        "num_leaves": 15,
        "learning_rate": 0.3,
        "subsample": 1.0,
        "colsample_bytree": 1.0,
    }
    fitted = BoostedTrees(params).fit(feature_rows(partials, zoning))
    predictions, _ = serving.predict_requests(
        _requests(spark, sf_dir), zoning, fitted, _as_of(), ["event_id"]
    )
    return predictions
