"""Splits, baselines, intervals and descriptive tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.common import ev_clean, ev_daily, ev_measured, ev_partials, ev_zoned, or_partials
from catalog.section import Section
from catalog.sql import N_ZONES, block, exact_mean, exact_sum, metrics, with_
from kerbcast.functions.exact import exact_mean as exact_mean_column
from kerbcast.functions.geo import great_circle_km
from kerbcast.operators import baselines as B
from kerbcast.operators import quality as Q
from kerbcast.operators.bootstrap import bootstrap_replicates, daily_errors, mae_interval
from kerbcast.operators.cleaning import with_raw_minutes
from kerbcast.operators.order_stats import exact_quantiles
from kerbcast.operators.scoring import error_metrics
from kerbcast.sources.standins import event_trips, table
from kerbcast.sources.trips import normalize_trips

register = Section()

CUT = dt.date(2024, 1, 22)
SPLIT = f"DATE '{CUT}'"

# --- splits --------------------------------------------------------------------------

block(
    "sided", "ev_zoned",
    sql="""SELECT *, CASE WHEN row_number() OVER (ORDER BY start_time, event_id)
      <= floor(0.8::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS side
      FROM ev_zoned""",
)


def _sided(spark, sf_dir):
    return B.chronological_sides(ev_zoned(spark, sf_dir), "event_id")


@register("j1_chronological_sides", with_("sided") + "SELECT event_id, side FROM sided")
def j1(spark, sf_dir):
    return _sided(spark, sf_dir).select("event_id", "side")


@register(
    "j1_split_diagnosis",
    with_("sided") + f"""SELECT side, count(*) AS n_rows,
      count(DISTINCT CAST(start_time AS DATE)) AS n_days,
      count(*) / {N_ZONES * 24}.0::DOUBLE AS mean_ride_count,
      count(*) / {N_ZONES * 24}.0::DOUBLE / count(DISTINCT CAST(start_time AS DATE))
        AS mean_daily_ride_count
      FROM sided GROUP BY side""",
)
def j1_diagnosis(spark, sf_dir):
    return B.split_diagnosis(_sided(spark, sf_dir), N_ZONES)


# --- baselines -----------------------------------------------------------------------

block("train", "ev_zhd", sql=f"SELECT * FROM ev_zhd WHERE date < {SPLIT}")
block(
    "zh_mean", "train",
    sql="""SELECT pickup_zone, hour, CAST(sum(ride_count) AS DOUBLE) / count(*) AS prediction
      FROM train GROUP BY ALL""",
)
block(
    "zhw_mean", "train",
    sql="""SELECT pickup_zone, hour, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
      CAST(sum(ride_count) AS DOUBLE) / count(*) AS prediction FROM train GROUP BY ALL""",
)
for _name, _days in (("naive7", 7), ("naive1", 1)):
    block(
        _name, "ev_zhd",
        sql=f"""SELECT a.pickup_zone, a.hour, a.date, a.ride_count,
          CAST(b.ride_count AS DOUBLE) AS prediction FROM ev_zhd a LEFT JOIN ev_zhd b
          ON a.pickup_zone = b.pickup_zone AND a.hour = b.hour AND b.date = a.date - {_days}""",
    )
_KEYS = "pickup_zone, hour, date, ride_count"
block(
    "predictions", "ev_zhd", "zh_mean", "zhw_mean", "naive7", "naive1",
    sql=f"""
    SELECT 'zone_hour_mean' AS predictor, {_KEYS}, prediction
      FROM ev_zhd LEFT JOIN zh_mean USING (pickup_zone, hour) WHERE date >= {SPLIT}
    UNION ALL SELECT 'zone_hour_weekday_mean', {_KEYS}, prediction FROM
      (SELECT *, isodow(date) - 1 AS day_of_week FROM ev_zhd) LEFT JOIN zhw_mean
        USING (pickup_zone, hour, day_of_week) WHERE date >= {SPLIT}
    UNION ALL SELECT 'seasonal_naive', {_KEYS}, prediction FROM naive7 WHERE date >= {SPLIT}
    UNION ALL SELECT 'persistence', {_KEYS}, prediction FROM naive1 WHERE date >= {SPLIT}""",
)


def _train(spark, sf_dir):
    return ev_daily(spark, sf_dir).filter(F.col("date") < F.lit(CUT))


@register("j2_zone_hour_mean", with_("zh_mean") + "SELECT * FROM zh_mean")
def j2(spark, sf_dir):
    return B.zone_hour_mean(_train(spark, sf_dir))


@register("j3_zone_hour_weekday_mean", with_("zhw_mean") + "SELECT * FROM zhw_mean")
def j3(spark, sf_dir):
    return B.zone_hour_weekday_mean(_train(spark, sf_dir))


@register(
    "e10_errors_by_the_plain_formula",
    with_("predictions") + """SELECT predictor, round(avg(abs(ride_count - prediction)), 3) AS mae,
      round(sqrt(avg((ride_count - prediction) * (ride_count - prediction))), 3) AS rmse,
      round(sum(abs(ride_count - prediction)) / sum(ride_count), 5) AS wape, count(*) AS n_test_rows
      FROM predictions WHERE prediction IS NOT NULL GROUP BY predictor""",
)
def e10_plain(spark, sf_dir):
    """The library's errors, to digits that steps of a millionth of a ride cannot reach."""
    scores = B.baseline_scores(ev_daily(spark, sf_dir), CUT)
    return scores.select(
        "predictor", F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"),
        F.round("wape", 5).alias("wape"), "n_test_rows",
    )


@register(
    "j4_e10_baseline_scores",
    with_("predictions") + f"""SELECT predictor, {metrics()} FROM predictions
      WHERE prediction IS NOT NULL GROUP BY predictor""",
)
def j4(spark, sf_dir):
    return B.baseline_scores(ev_daily(spark, sf_dir), CUT)


@register(
    "j4_e10_scores_on_shared_rows",
    with_("predictions") + f"""
    , filled AS (SELECT p.predictor, p.pickup_zone, p.hour, p.date, p.ride_count,
        CASE WHEN p.predictor = 'zone_hour_weekday_mean' THEN coalesce(p.prediction, m.prediction)
          ELSE p.prediction END AS prediction
      FROM predictions p LEFT JOIN zh_mean m USING (pickup_zone, hour)),
    shared AS (SELECT pickup_zone, hour, date FROM filled GROUP BY ALL HAVING count(prediction) = 4)
    SELECT s.predictor, n_rows, mae, rmse, wape, coalesce(n_test_rows, 0) AS n_test_rows
      FROM (SELECT predictor, count(*) AS n_rows FROM filled GROUP BY predictor) s
      LEFT JOIN (SELECT predictor, {metrics()} FROM filled SEMI JOIN shared USING (pickup_zone, hour, date)
        GROUP BY predictor) USING (predictor)""",
)
def j4_shared(spark, sf_dir):
    return B.shared_baseline_scores(ev_daily(spark, sf_dir), CUT)


@register(
    "e10_scores_by_hour",
    with_("predictions") + f"""SELECT predictor, hour, {metrics()} FROM predictions
      WHERE prediction IS NOT NULL GROUP BY predictor, hour""",
)
def e10(spark, sf_dir):
    rows = B.baseline_predictions(ev_daily(spark, sf_dir), CUT)
    return error_metrics(rows, ["predictor", "hour"])


@register("j5_seasonal_naive", with_("naive7") + "SELECT * FROM naive7")
def j5(spark, sf_dir):
    return B.seasonal_naive(ev_daily(spark, sf_dir))


@register("j6_persistence", with_("naive1") + "SELECT * FROM naive1")
def j6(spark, sf_dir):
    return B.persistence(ev_daily(spark, sf_dir))


@register(
    "j7_recency_features",
    with_("ev_zhd") + """SELECT *, lag(ride_count) OVER w AS last_count,
      CAST(sum(ride_count) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE)
        / nullif(count(*) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS rolling_mean
      FROM ev_zhd WINDOW w AS (PARTITION BY pickup_zone, hour ORDER BY date)""",
)
def j7(spark, sf_dir):
    return B.recency_features(ev_daily(spark, sf_dir))


# --- bootstrap -----------------------------------------------------------------------

block(
    "day_errors", "predictions",
    sql=f"""SELECT date, {exact_sum('abs(ride_count - prediction)')} AS abs_error, count(*) AS n
      FROM predictions WHERE predictor = 'zone_hour_weekday_mean' GROUP BY date""",
)
block(
    "replicates", "day_errors",
    sql=f"""
    SELECT replicate, ({exact_sum('abs_error')}) / sum(n) AS mae
    FROM (SELECT r AS replicate, 1 + CAST('0x' || substr(md5(r || ':' || day_no), 1, 8) AS BIGINT)
            % (SELECT count(*) FROM day_errors) AS pick
          FROM (SELECT row_number() OVER (ORDER BY date) AS day_no FROM day_errors)
            CROSS JOIN range(1, 2001) t(r))
      JOIN (SELECT row_number() OVER (ORDER BY date) AS pick, abs_error, n FROM day_errors)
        USING (pick) GROUP BY replicate""",
)


def _day_errors(spark, sf_dir):
    rows = B.baseline_predictions(ev_daily(spark, sf_dir), CUT)
    return daily_errors(rows.filter("predictor = 'zone_hour_weekday_mean'"))


@register("j8_daily_errors", with_("day_errors") + "SELECT * FROM day_errors")
def j8_days(spark, sf_dir):
    return _day_errors(spark, sf_dir)


@register(
    "j8_bootstrap_replicates",
    with_("replicates") + "SELECT CAST(replicate AS INTEGER) AS replicate, mae FROM replicates",
)
def j8_replicates(spark, sf_dir):
    return bootstrap_replicates(_day_errors(spark, sf_dir))


@register(
    "j8_mae_interval",
    with_("replicates", "day_errors") + f"""
    SELECT (SELECT ({exact_sum('abs_error')}) / sum(n) FROM day_errors) AS mae,
      round(quantile_cont(mae, 0.025), 9) AS mae_low, round(quantile_cont(mae, 0.975), 9) AS mae_high
    FROM replicates""",
)
def j8_interval(spark, sf_dir):
    interval = mae_interval(_day_errors(spark, sf_dir))
    return interval.withColumns(
        {"mae_low": F.round("mae_low", 9), "mae_high": F.round("mae_high", 9)}
    )


# --- quality and description ---------------------------------------------------------


@register(
    "j9_duplicates_and_spans_events",
    with_("ev_raw") + """, g AS (SELECT start_time, end_time, pickup_location_id,
        dropoff_location_id, miles, fare_amount, count(*) AS n FROM ev_raw GROUP BY ALL)
      SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
        CAST(coalesce(sum(n) FILTER (end_time <= start_time), 0) AS BIGINT) AS non_positive_spans
      FROM g""",
)
def j9_events(spark, sf_dir):
    trips = with_raw_minutes(normalize_trips(event_trips(spark, sf_dir)))
    columns = [name for name in trips.columns if name != "_minutes"]
    return Q.duplicate_and_span_counts(trips, columns, "_minutes")


@register(
    "j9_duplicates_and_spans_shipments",
    """WITH g AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_shipdate,
        date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days, count(*) AS n
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
      SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
        CAST(sum(n) FILTER (days <= 0) AS BIGINT) AS non_positive_spans FROM g""",
)
def j9_shipments(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    days = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    columns = ["l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]
    return Q.duplicate_and_span_counts(lines.withColumn("days", days), columns, "days")


def _profile(by: str, key: str) -> str:
    return with_("ev_partials") + f"""
      , p AS (SELECT CAST({key} AS INTEGER) AS {by}, CAST(sum(ride_count) AS BIGINT) AS rides,
        ({exact_sum('duration_sum', '6e7')}) / nullif(CAST(sum(duration_n) AS DOUBLE), 0)
          AS mean_duration_min FROM ev_partials GROUP BY ALL) """


@register("j10_profile_by_hour", _profile("hour", "hour") + "SELECT * FROM p")
def j10_hour(spark, sf_dir):
    return Q.temporal_profile(ev_partials(spark, sf_dir), "hour")


@register("j10_profile_by_weekday", _profile("day_of_week", "isodow(date) - 1") + "SELECT * FROM p")
def j10_weekday(spark, sf_dir):
    return Q.temporal_profile(ev_partials(spark, sf_dir), "day_of_week")


@register(
    "j10_peak_and_trough",
    _profile("hour", "hour") + """SELECT
      (SELECT hour FROM p ORDER BY rides DESC, hour LIMIT 1) AS peak_hour,
      (SELECT max(rides) FROM p) AS peak_rides,
      (SELECT hour FROM p ORDER BY rides, hour LIMIT 1) AS trough_hour,
      (SELECT min(rides) FROM p) AS trough_rides""",
)
def j10_peak(spark, sf_dir):
    return Q.peak_and_trough(Q.temporal_profile(ev_partials(spark, sf_dir), "hour"), "hour")


@register(
    "j11_daily_series_orders",
    with_("or_partials") + """, d AS (SELECT date, CAST(sum(ride_count) AS BIGINT) AS rides
        FROM or_partials GROUP BY date)
      SELECT date, rides, rides / (SELECT median(rides) FROM d) AS share_of_median,
        rides / (SELECT median(rides) FROM d) < 0.5 AS is_shock FROM d""",
)
def j11(spark, sf_dir):
    return Q.daily_series(or_partials(spark, sf_dir))


def _fences(column: str) -> str:
    return f"""SELECT '{column}' AS coordinate, low AS low_fence, high AS high_fence,
      count(*) FILTER ({column} < low OR {column} > high) AS outliers,
      count(*) FILTER ({column} < low OR {column} > high) / CAST(count({column}) AS DOUBLE)
        AS outlier_share
      FROM ev_clean, (SELECT q[1] - 1.5::DOUBLE * (q[2] - q[1]) AS low,
          q[2] + 1.5::DOUBLE * (q[2] - q[1]) AS high
        FROM (SELECT quantile_cont({column}, [0.25, 0.75]) AS q FROM ev_clean)) GROUP BY ALL"""


@register(
    "j12_iqr_outlier_shares",
    with_("ev_clean") + " UNION ALL ".join(_fences(name) for name in Q.COORDINATES),
)
def j12(spark, sf_dir):
    return Q.iqr_outlier_shares(ev_clean(spark, sf_dir))


@register(
    "j12_exact_quantiles_at_scale",
    """SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
      quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem""",
)
def j12_refined(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    found = exact_quantiles(lines, ["l_extendedprice"], [0.25, 0.5, 0.75])
    q1, q2, q3 = found["l_extendedprice"]
    return spark.range(1).select(F.lit(q1).alias("q1"), F.lit(q2).alias("q2"), F.lit(q3).alias("q3"))


_IN = "BETWEEN 40.4766::DOUBLE AND 40.9176::DOUBLE"
_IN_LNG = "BETWEEN -74.2588::DOUBLE AND -73.7002::DOUBLE"


@register(
    "j13_boundary_outliers",
    with_("ev_clean") + f"""
    , f AS (SELECT NOT coalesce(start_lat + shift {_IN} AND start_lng {_IN_LNG}, true) AS a,
        NOT coalesce(end_lat + shift {_IN} AND end_lng {_IN_LNG}, true) AS b
      FROM (SELECT *, (event_id % 7) * 0.02::DOUBLE AS shift FROM ev_clean))
    SELECT count(*) AS n_rows, count(*) FILTER (a) AS bad_start, count(*) FILTER (b) AS bad_end,
      count(*) FILTER (a OR b) AS outliers,
      count(*) FILTER (a OR b) / CAST(count(*) AS DOUBLE) AS outlier_share FROM f""",
)
def j13(spark, sf_dir):
    # The stand-in locations all lie inside, so points are moved north by up to 0.12.
    shift = (F.col("event_id") % 7) * F.lit(0.02)
    moved = ev_clean(spark, sf_dir).withColumns(
        {"start_lat": F.col("start_lat") + shift, "end_lat": F.col("end_lat") + shift}
    )
    return Q.boundary_outliers(moved)


block(
    "calendar_table",
    sql=f"""SELECT CAST(l_shipdate AS DATE) AS date, {exact_mean('l_discount', '1e9')} AS weather,
      max(l_quantity) = 50 AS is_holiday FROM lineitem GROUP BY ALL""",
)


@register(
    "j15_calendar_enrichment",
    with_("or_partials", "calendar_table") + """SELECT pickup_location_id, date, hour, ride_count,
      weather, is_holiday FROM or_partials LEFT JOIN calendar_table USING (date)""",
)
def j15(spark, sf_dir):
    calendar = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            exact_mean_column("l_discount", 1e9).alias("weather"),
            (F.max("l_quantity") == 50).alias("is_holiday"),
        )
    )
    enriched = Q.with_calendar(or_partials(spark, sf_dir), calendar)
    return enriched.select(
        "pickup_location_id", "date", "hour", "ride_count", "weather", "is_holiday"
    )


@register(
    "j16_great_circle_km",
    with_("ev_clean") + """SELECT event_id, round(2 * 6371.0::DOUBLE * asin(least(1.0::DOUBLE, sqrt(
        sin(radians(end_lat - start_lat) / 2) * sin(radians(end_lat - start_lat) / 2)
        + cos(radians(start_lat)) * cos(radians(end_lat))
          * sin(radians(end_lng - start_lng) / 2) * sin(radians(end_lng - start_lng) / 2)))), 6)
        AS km FROM ev_clean""",
)
def j16(spark, sf_dir):
    km = great_circle_km(*(F.col(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")))
    return ev_clean(spark, sf_dir).select("event_id", F.round(km, 6).alias("km"))


block(
    "random_sides", "ev_zhd",
    sql="""SELECT *, CASE WHEN CAST('0x' || substr(md5(strftime(date, '%Y-%m-%d')), 1, 8) AS BIGINT)
      % 100 < 20 THEN 'test' ELSE 'train' END AS side FROM ev_zhd""",
)


@register("j17_random_day_sides", with_("random_sides") + "SELECT DISTINCT date, side FROM random_sides")
def j17_sides(spark, sf_dir):
    return B.random_day_sides(ev_daily(spark, sf_dir)).select("date", "side").distinct()


@register(
    "j17_random_day_scores",
    with_("random_sides") + f"""
    , m AS (SELECT pickup_zone, hour, isodow(date) AS d, CAST(sum(ride_count) AS DOUBLE) / count(*)
        AS prediction FROM random_sides WHERE side = 'train' GROUP BY ALL)
    SELECT {metrics()} FROM (SELECT *, isodow(date) AS d FROM random_sides WHERE side = 'test')
      JOIN m USING (pickup_zone, hour, d)""",
)
def j17(spark, sf_dir):
    return B.split_scores(B.random_day_sides(ev_daily(spark, sf_dir)))


block(
    "tiles", "ev_zhd",
    sql="""SELECT date, ntile(5) OVER (ORDER BY date) AS tile
      FROM (SELECT DISTINCT date FROM ev_zhd)""",
)


@register(
    "j18_expanding_folds",
    with_("tiles") + """SELECT CAST(f AS INTEGER) AS fold, date,
      CASE WHEN tile <= f THEN 'train' ELSE 'test' END AS role
      FROM tiles JOIN range(1, 5) r(f) ON tile <= f + 1""",
)
def j18(spark, sf_dir):
    return B.expanding_folds(ev_daily(spark, sf_dir), 4)


@register(
    "j18_expanding_fold_scores",
    with_("tiles", "ev_zhd") + f"""
    , d AS (SELECT z.*, isodow(date) AS dow, tile FROM ev_zhd z JOIN tiles USING (date))
    , m AS (SELECT f, pickup_zone, hour, dow, CAST(sum(ride_count) AS DOUBLE) / count(*) AS prediction
        FROM d JOIN range(1, 5) r(f) ON tile <= f GROUP BY ALL)
    SELECT CAST(f AS INTEGER) AS fold, {metrics()} FROM d JOIN m
      ON m.f = d.tile - 1 AND m.pickup_zone = d.pickup_zone AND m.hour = d.hour AND m.dow = d.dow
      GROUP BY f""",
)
def j18_scores(spark, sf_dir):
    return B.expanding_fold_scores(ev_daily(spark, sf_dir), 4)


@register(
    "a1_normalized_missing_values",
    with_("ev_measured") + """SELECT count(*) AS kept, count(*) - count(ride_duration_min) AS
      no_minutes, count(*) - count(ride_distance_km) AS no_km, count(*) - count(fare_amount) AS no_fare
      FROM ev_measured""",
)
def a1_missing(spark, sf_dir):
    missing = [
        (F.count("*") - F.count(source)).alias(name)
        for source, name in (
            ("ride_duration_min", "no_minutes"),
            ("ride_distance_km", "no_km"),
            ("fare_amount", "no_fare"),
        )
    ]
    return ev_measured(spark, sf_dir).agg(F.count("*").alias("kept"), *missing)
