"""Periods, folds, summaries, backtests and search."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from catalog.common import ev_zoning, or_covered, or_partials
from catalog.kmeans import SILHOUETTES, kmeans, squared
from catalog.section import Section
from catalog.sql import BLOCKS, block, exact_mean, exact_sum, lattice_centres, metrics, nearest, with_
from kerbcast import settings as S
from kerbcast.functions.clock import month_text, months_ending_at, parse_month, shift_month
from kerbcast.functions.exact import exact_mean as mean
from kerbcast.operators import periods as P
from kerbcast.operators import scoring
from kerbcast.operators.partials import months_of
from kerbcast.operators.scoring import error_metrics
from kerbcast.operators.zoning import (
    assign_zones,
    fit_centres,
    inertia,
    pickup_points,
    zone_map,
)
from kerbcast.plans import experiments as X
from kerbcast.plans.forecast import (
    BoostedTrees,
    WeekdayMean,
    evaluate,
    feature_rows,
    fit_zoning,
    train,
    zoning_from_centres,
)
from kerbcast.session import settle
from kerbcast.sources.standins import lattice_centroids, table

register = Section()

# Small trees, so that the registered runs show the whole path in seconds.
QUICK_TREES = {
    "n_estimators": 4,
    "num_leaves": 15,
    "learning_rate": 0.3,
    "subsample": 1.0,
    "colsample_bytree": 1.0,
}

# --- months --------------------------------------------------------------------------

# Every month of all orders, but for those whose number of orders is divisible by seven: that
# leaves holes, as missing files would.
block(
    "present",
    sql="""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
      GROUP BY ALL HAVING count(*) % 7 <> 0""",
)


def _present(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    holes = orders.groupBy(month).agg(F.count("*").alias("n")).filter("n % 7 = 0")
    return P.months_present(orders, "o_orderdate").join(holes, "month", "left_anti")


@register("a4_months_present", with_("present") + "SELECT month FROM present")
def a4(spark, sf_dir):
    return _present(spark, sf_dir)


@register(
    "c7_month_windows_of_orders",
    """SELECT m AS month, CAST(unnest(generate_series(m - INTERVAL 4 MONTH, m - INTERVAL 2 MONTH,
        INTERVAL 1 MONTH)) AS DATE) AS train_month
      FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)""",
)
def c7(spark, sf_dir):
    months = P.months_present(table(spark, sf_dir, "orders"), "o_orderdate")
    last = F.add_months("month", -S.EVAL_GAP_MONTHS)
    return months.withColumn("train_month", F.explode(months_ending_at(last, F.lit(3))))


@register(
    "c8_month_text",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
      strftime(o_orderdate, '%Y-%m') AS shown FROM orders""",
)
def c8(spark, sf_dir):
    day = F.col("o_orderdate")
    loose = F.concat_ws("-", F.year(day).cast("string"), F.month(day).cast("string"))
    month = parse_month(loose)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month.alias("month"), month_text(month).alias("shown")
    )


WINDOW = """, w AS (SELECT CAST(unnest(generate_series((SELECT max(month) FROM present)
    - INTERVAL 23 MONTH, (SELECT max(month) FROM present), INTERVAL 1 MONTH)) AS DATE) AS month)"""


@register(
    "f3_h3_calendar_window",
    with_("present") + WINDOW + " SELECT month, month IN (SELECT month FROM present) AS is_present FROM w",
)
def f3(spark, sf_dir):
    present = _present(spark, sf_dir)
    last = present.agg(F.max("month")).first()[0]
    return P.window_months(present, last, 24)


@register(
    "h3_window_set_operations",
    with_("present") + WINDOW + """
    SELECT month, 'wanted and present' AS kind FROM (SELECT month FROM w INTERSECT SELECT month FROM present)
    UNION ALL SELECT month, 'wanted only' FROM (SELECT month FROM w EXCEPT SELECT month FROM present)
    UNION ALL SELECT month, 'present only' FROM (SELECT month FROM present EXCEPT SELECT month FROM w)""",
)
def h3(spark, sf_dir):
    present = _present(spark, sf_dir)
    last = present.agg(F.max("month")).first()[0]
    wanted = P.window_months(present, last, 24).select("month")
    parts = {
        "wanted and present": wanted.intersect(present),
        "wanted only": wanted.subtract(present),
        "present only": present.subtract(wanted),
    }
    first, second, third = (df.withColumn("kind", F.lit(kind)) for kind, df in parts.items())
    return first.unionByName(second).unionByName(third)


@register(
    "g3_latest_months",
    with_("present") + "SELECT month FROM present ORDER BY month DESC LIMIT 6",
)
def g3(spark, sf_dir):
    return P.latest_months(_present(spark, sf_dir), 6)


block(
    "fold_wanted", "present",
    sql="""SELECT t.month AS test_month, w AS window_months,
      CAST(unnest(generate_series(t.month - to_months(CAST(w + 1 AS INTEGER)), t.month - INTERVAL 2 MONTH,
        INTERVAL 1 MONTH)) AS DATE) AS train_month
    FROM (SELECT month FROM present ORDER BY month DESC LIMIT 12) t
      CROSS JOIN (SELECT unnest([1, 2, 3, 6]) AS w)""",
)
block(
    "fold_windows", "fold_wanted",
    sql="""SELECT *, bool_and(is_present) OVER (PARTITION BY test_month, window_months) AS is_complete
    FROM (SELECT *, train_month IN (SELECT month FROM present) AS is_present FROM fold_wanted)""",
)


def _folds(spark, sf_dir):
    return P.fold_windows(_present(spark, sf_dir), [1, 2, 3, 6, 3], 12, 2)


@register("f4_rolling_origin_folds", with_("fold_windows") + "SELECT * FROM fold_windows")
def f4(spark, sf_dir):
    return _folds(spark, sf_dir)


@register(
    "b10_complete_windows",
    with_("fold_windows")
    + "SELECT test_month, window_months, train_month FROM fold_windows WHERE is_complete",
)
def b10(spark, sf_dir):
    return P.complete_folds(_folds(spark, sf_dir))


@register(
    "f4_shortened_windows",
    with_("fold_windows")
    + "SELECT test_month, window_months, train_month FROM fold_windows WHERE is_present",
)
def f4_short(spark, sf_dir):
    return P.shortened_folds(_folds(spark, sf_dir))


# --- summaries over results derived from lineitem ------------------------------------

_RESULT_SQL = f"""SELECT [3, 6, 12, 24][l_linenumber % 4 + 1] AS window_months,
      CAST(10 + 10 * (l_suppkey % 2) AS INTEGER) AS n_zones,
      strftime(l_shipdate, '%Y-%m-%d') AS test_month, {exact_mean('l_quantity')} AS mae,
      {exact_mean('l_extendedprice / 1000')} AS rmse, {exact_mean('l_discount')} AS wape,
      {exact_mean('l_tax')} AS smallest_zone_share
    FROM lineitem GROUP BY ALL"""
block("results", sql=_RESULT_SQL)


def _results(spark, sf_dir):
    """Backtest-shaped rows.  Test periods are days here, so that some lack a setting."""
    lines = table(spark, sf_dir, "lineitem")
    windows = F.array(*[F.lit(n) for n in S.BACKTEST_WINDOWS])
    return (
        lines.groupBy(
            windows[F.col("l_linenumber") % 4].alias("window_months"),
            (F.col("l_suppkey") % 2 * 10 + 10).cast("int").alias("n_zones"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("test_month"),
        ).agg(
            mean(F.col("l_quantity")).alias("mae"),
            mean(F.col("l_extendedprice") / 1000).alias("rmse"),
            mean(F.col("l_discount")).alias("wape"),
            mean(F.col("l_tax")).alias("smallest_zone_share"),
        )
    )


block(
    "common_months", "results",
    sql="""SELECT test_month FROM results GROUP BY test_month HAVING count(*) =
      (SELECT count(*) FROM (SELECT DISTINCT window_months, n_zones FROM results))""",
)


@register("b9_common_test_months", with_("common_months") + "SELECT test_month FROM common_months")
def b9(spark, sf_dir):
    return scoring.common_test_months(_results(spark, sf_dir))


@register(
    "e12_backtest_summary",
    with_("common_months") + f"""SELECT window_months, n_zones,
      count(DISTINCT test_month) AS test_months, {exact_mean('mae')} AS mae,
      {exact_mean('rmse')} AS rmse, {exact_mean('wape', '1e9')} AS wape,
      {exact_mean('smallest_zone_share', '1e9')} AS smallest_zone_share
      FROM results WHERE test_month IN (SELECT test_month FROM common_months) GROUP BY ALL""",
)
def e12(spark, sf_dir):
    # Every row twice: a repeated setting must not count as another one.
    results = _results(spark, sf_dir)
    return scoring.summarize_backtest(results.unionByName(results))


@register(
    "h5_first_row_per_setting",
    """SELECT l_suppkey, arg_min(l_partkey, (l_orderkey, l_linenumber, l_partkey)) AS l_partkey
      FROM lineitem GROUP BY ALL""",
)
def h5(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"
    )
    first = scoring.first_rows(lines, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"])
    return first.select("l_suppkey", "l_partkey")


block(
    "fold_scores",
    sql=f"""SELECT CAST(l_partkey % 31 AS INTEGER) AS trial_index, l_shipdate AS fold,
      {exact_mean('l_discount')} AS wape, {exact_mean('l_quantity')} AS mae,
      {exact_mean('l_extendedprice / 1000')} AS rmse FROM lineitem GROUP BY ALL""",
)
block(
    "trials", "fold_scores",
    sql=f"""SELECT trial_index, {exact_mean('wape', '1e9')} AS wape, {exact_mean('mae')} AS mae,
      {exact_mean('rmse')} AS rmse, count(*) AS folds FROM fold_scores GROUP BY ALL""",
)


def _trials(spark, sf_dir):
    scores = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_partkey") % 31).cast("int").alias("trial_index"), "l_shipdate")
        .agg(
            mean(F.col("l_discount")).alias("wape"),
            mean(F.col("l_quantity")).alias("mae"),
            mean(F.col("l_extendedprice") / 1000).alias("rmse"),
        )
    )
    return scoring.mean_over_folds(scores, ["trial_index"])


@register("e13_mean_over_folds", with_("trials") + "SELECT * FROM trials")
def e13(spark, sf_dir):
    return _trials(spark, sf_dir)


@register(
    "g4_best_trials",
    with_("trials") + "SELECT * FROM trials ORDER BY wape, trial_index LIMIT 10",
)
def g4(spark, sf_dir):
    return scoring.best_first(_trials(spark, sf_dir), 10)


@register(
    "g5_best_zone_count",
    f"""SELECT CAST(l_linenumber * 5 AS INTEGER) AS k, {exact_mean('l_discount')} AS silhouette
      FROM lineitem GROUP BY ALL ORDER BY silhouette DESC, k LIMIT 1""",
)
def g5(spark, sf_dir):
    results = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_linenumber") * 5).cast("int").alias("k"))
        .agg(mean(F.col("l_discount")).alias("silhouette"))
    )
    return X.best_zone_count(results)


# --- the mean backtest over orders ---------------------------------------------------

ZONE_COUNTS = (5, 20, 60)
WINDOWS = (3, 6, 12, 24)
block(
    "zone_maps", "centroids",
    sql=" UNION ALL ".join(
        f"""SELECT {k} AS n_zones, location_id AS pickup_location_id,
        CAST({nearest('lat', 'lng', lattice_centres(k))} AS INTEGER) AS pickup_zone FROM centroids"""
        for k in ZONE_COUNTS
    ),
)
block(
    "or_months", "or_partials",
    sql="SELECT *, CAST(date_trunc('month', date) AS DATE) AS month FROM or_partials",
)
block(
    "bt_folds", "or_months",
    sql=f"""SELECT * EXCLUDE (ok) FROM (SELECT *, bool_and(train_month IN (SELECT month FROM or_months))
        OVER (PARTITION BY test_month, window_months) AS ok
      FROM (SELECT t.month AS test_month, w AS window_months,
        CAST(unnest(generate_series(t.month - to_months(CAST(w + 1 AS INTEGER)),
          t.month - INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS DATE) AS train_month
        FROM (SELECT DISTINCT month FROM or_months ORDER BY month DESC LIMIT 6) t
          CROSS JOIN (SELECT unnest({list(WINDOWS)}) AS w))) WHERE ok""",
)
block(
    "bt_settings", "bt_folds", "or_months",
    sql=f"""SELECT test_month, window_months, k AS n_zones, n AS n_points FROM (
        SELECT test_month, window_months, count(DISTINCT pickup_location_id) AS n
        FROM bt_folds JOIN or_months ON month = train_month GROUP BY ALL)
      CROSS JOIN (SELECT unnest({list(ZONE_COUNTS)}) AS k) WHERE k < n""",
)
block(
    "bt_train", "bt_folds", "or_months", "zone_maps", "bt_settings",
    sql="""SELECT test_month, window_months, n_zones, pickup_zone, hour, isodow(date) AS dow,
        sum(ride_count) AS rides
      FROM bt_folds JOIN or_months ON month = train_month JOIN zone_maps USING (pickup_location_id)
        JOIN bt_settings USING (test_month, window_months, n_zones) GROUP BY ALL""",
)
block(
    "bt_days", "bt_folds", "or_months",
    sql="""SELECT test_month, window_months, isodow(date) AS dow, count(DISTINCT date) AS days
      FROM bt_folds JOIN or_months ON month = train_month GROUP BY ALL""",
)
block(
    "bt_truth", "bt_settings", "or_months", "zone_maps",
    sql="""SELECT s.test_month, s.window_months, s.n_zones, z AS pickup_zone, h AS hour, d.date,
        coalesce(n, 0) AS ride_count
      FROM bt_settings s JOIN (SELECT DISTINCT month, date FROM or_months) d ON d.month = s.test_month
        CROSS JOIN range(24) b(h) CROSS JOIN range(60) a(z)
        LEFT JOIN (SELECT n_zones, pickup_zone, hour, date, sum(ride_count) AS n FROM or_months
                   JOIN zone_maps USING (pickup_location_id) GROUP BY ALL) c
          ON c.n_zones = s.n_zones AND c.pickup_zone = z AND c.hour = h AND c.date = d.date
      WHERE z < s.n_zones""",
)
block(
    "backtest", "bt_truth", "bt_train", "bt_days",
    sql=f"""
    SELECT m.*, smallest_zone_share FROM (
      SELECT test_month, window_months, n_zones, {metrics()} FROM (
        SELECT t.*, CASE WHEN days IS NOT NULL THEN coalesce(rides, 0) / days
                    ELSE coalesce(all_rides, 0) / all_days END AS prediction
        FROM (SELECT *, isodow(date) AS dow FROM bt_truth) t
          LEFT JOIN bt_days USING (test_month, window_months, dow)
          LEFT JOIN bt_train USING (test_month, window_months, n_zones, pickup_zone, hour, dow)
          LEFT JOIN (SELECT test_month, window_months, n_zones, pickup_zone, hour,
              sum(rides) AS all_rides FROM bt_train GROUP BY ALL)
            USING (test_month, window_months, n_zones, pickup_zone, hour)
          LEFT JOIN (SELECT test_month, window_months, sum(days) AS all_days FROM bt_days GROUP BY ALL)
            USING (test_month, window_months)) GROUP BY ALL) m
    JOIN (SELECT test_month, window_months, n_zones,
        CASE WHEN count(*) < max(n_zones) THEN 0 ELSE min(r) END / CAST(sum(r) AS DOUBLE) AS smallest_zone_share
      FROM (SELECT test_month, window_months, n_zones, pickup_zone, sum(rides) AS r FROM bt_train
            GROUP BY ALL) GROUP BY ALL) USING (test_month, window_months, n_zones)""",
)


def _zone_maps(spark):
    maps = [
        zone_map(lattice_centroids(spark), lattice_centres(k)).withColumn("n_zones", F.lit(k))
        for k in ZONE_COUNTS
    ]
    return maps[0].unionByName(maps[1]).unionByName(maps[2])


def _backtest(spark, sf_dir):
    # The SQL beside it takes months as they are, also those with missing days.
    return X.mean_backtest(
        or_partials(spark, sf_dir), _zone_maps(spark), ZONE_COUNTS, WINDOWS, full_months=False
    )


@register(
    "i8_e11_mean_backtest",
    with_("backtest") + """SELECT window_months, n_zones, strftime(test_month, '%Y-%m') AS test_month,
      mae, rmse, wape, smallest_zone_share, n_test_rows FROM backtest""",
)
def i8(spark, sf_dir):
    return _backtest(spark, sf_dir)


@register(
    "b11_usable_zone_counts",
    with_("bt_settings") + "SELECT * FROM bt_settings",
)
def b11(spark, sf_dir):
    partials = or_partials(spark, sf_dir)
    folds = P.complete_folds(P.fold_windows(P.months_present(partials), WINDOWS))
    return X.usable_zone_counts(partials, folds, ZONE_COUNTS)


@register(
    "i8_e12_mean_backtest_summary",
    with_("backtest") + f"""
    , common AS (SELECT test_month FROM backtest GROUP BY 1 HAVING count(*) =
        (SELECT count(*) FROM (SELECT DISTINCT window_months, n_zones FROM backtest)))
    SELECT window_months, n_zones, count(DISTINCT test_month) AS test_months,
      {exact_mean('mae')} AS mae, {exact_mean('rmse')} AS rmse, {exact_mean('wape', '1e9')} AS wape,
      {exact_mean('smallest_zone_share', '1e9')} AS smallest_zone_share
    FROM backtest WHERE test_month IN (SELECT test_month FROM common) GROUP BY ALL""",
)
def i8_summary(spark, sf_dir):
    return scoring.summarize_backtest(_backtest(spark, sf_dir))


_MONTHS = BLOCKS["or_months"][1]
#: The backtest's blocks over months that have no day without trips or with very few.
def _covered(*names):
    return with_(*names).replace(f"or_months AS ({_MONTHS})", _COVERED_MONTHS)


_COVERED_MONTHS = f"""or_all_months AS ({_MONTHS}),
    or_day_counts AS (SELECT month, date, sum(ride_count) AS n FROM or_all_months GROUP BY ALL),
    or_covered AS (SELECT month FROM (SELECT *, median(n) OVER (PARTITION BY month) AS mid FROM or_day_counts)
      GROUP BY month HAVING count(*) = day(last_day(month)) AND bool_and(n >= {S.LOW_DAY_SHARE_OF_MEDIAN} * mid)),
    or_months AS (SELECT * FROM or_all_months WHERE month IN (SELECT month FROM or_covered))"""
_COVERED = _covered("backtest")


def _covered_backtest(spark, sf_dir):
    partials = or_covered(spark, sf_dir)
    return X.mean_backtest(partials, _zone_maps(spark), ZONE_COUNTS, WINDOWS)


@register(
    "i8_e11_mean_backtest_covered",
    _COVERED + """SELECT window_months, n_zones, strftime(test_month, '%Y-%m') AS test_month,
      mae, rmse, wape, smallest_zone_share, n_test_rows FROM backtest""",
)
def i8_covered(spark, sf_dir):
    return _covered_backtest(spark, sf_dir)


@register(
    "i8_e12_mean_backtest_summary_covered",
    _COVERED + f"""
    , common AS (SELECT test_month FROM backtest GROUP BY 1 HAVING count(*) =
        (SELECT count(*) FROM (SELECT DISTINCT window_months, n_zones FROM backtest)))
    SELECT window_months, n_zones, count(DISTINCT test_month) AS test_months,
      {exact_mean('mae')} AS mae, {exact_mean('rmse')} AS rmse, {exact_mean('wape', '1e9')} AS wape,
      {exact_mean('smallest_zone_share', '1e9')} AS smallest_zone_share
    FROM backtest WHERE test_month IN (SELECT test_month FROM common) GROUP BY ALL""",
)
def i8_summary_covered(spark, sf_dir):
    return scoring.summarize_backtest(_covered_backtest(spark, sf_dir))


# --- one training run, fixed centres and weekday mean --------------------------------

_END = "(SELECT max(month) FROM or_months)"
block(
    "ev_train_rows", "or_months", "zone_map",
    sql=f"""SELECT d.date, isodow(d.date) AS dow, d.month, z AS pickup_zone, h AS hour,
        coalesce(n, 0) AS ride_count
      FROM (SELECT DISTINCT month, date FROM or_months) d CROSS JOIN range(20) a(z)
        CROSS JOIN range(24) b(h)
        LEFT JOIN (SELECT pickup_zone, hour, date, sum(ride_count) AS n FROM or_months
          JOIN zone_map USING (pickup_location_id) GROUP BY ALL) c
          ON c.pickup_zone = z AND c.hour = h AND c.date = d.date""",
)


@register(
    "i7_evaluate_weekday_mean",
    with_("ev_train_rows") + f"""
    , fit AS (SELECT pickup_zone, hour, dow, CAST(sum(ride_count) AS DOUBLE) / count(*) AS p
        FROM ev_train_rows WHERE month BETWEEN {_END} - INTERVAL 14 MONTH AND {_END} - INTERVAL 3 MONTH
        GROUP BY ALL)
    SELECT {metrics(guess='p')} FROM ev_train_rows JOIN fit USING (pickup_zone, hour, dow)
      WHERE month = {_END} - INTERVAL 1 MONTH""",
)
def i7_evaluate(spark, sf_dir):
    # The latest month has a single day, so the month before it is the test month.
    partials = or_partials(spark, sf_dir)
    present = P.months_present(partials)
    last = present.agg(F.max("month")).first()[0]
    test = shift_month(last, -1)
    window = months_of(partials, P.present_window(present, shift_month(test, -2), 12))
    zoning = zoning_from_centres(window, lattice_centroids(spark), lattice_centres(20))
    fitted = WeekdayMean().fit(feature_rows(window, zoning))
    return evaluate(fitted, zoning, months_of(partials, [test]))


# --- fits SQL cannot follow ----------------------------------------------------------


_ALL_POINTS = """, km_points AS MATERIALIZED (SELECT '' AS fold, pickup_location_id AS p, lat, lng, CAST(sum(ride_count) AS BIGINT) AS w
    FROM or_partials JOIN centroids ON location_id = pickup_location_id GROUP BY ALL)"""
_KMEANS = f"{_ALL_POINTS}, {kmeans('km_points', [S.N_ZONES])} "


@register(
    "i1_weighted_kmeans_zones",
    with_("or_partials", "centroids") + _KMEANS + """SELECT p AS pickup_location_id, lat AS start_lat,
      lng AS start_lng, w AS weight, z AS pickup_zone FROM km_labels""",
)
def i1(spark, sf_dir):
    points = pickup_points(or_partials(spark, sf_dir), lattice_centroids(spark))
    return assign_zones(points, fit_centres(points))


@register(
    "i1_kmeans_fixed_point",
    """SELECT CAST(NULL AS INTEGER) AS pickup_zone, CAST(NULL AS DOUBLE) AS off WHERE false""",
)
def i1_checked(spark, sf_dir):
    """Zones whose centre is not the weighted mean of the points nearest to it, or that have
    no point: none, if the fit settled."""
    points = settle(pickup_points(or_partials(spark, sf_dir), lattice_centroids(spark)))
    centres = fit_centres(points)
    weight = F.sum("weight").cast("double")
    means = assign_zones(points, centres).groupBy("pickup_zone").agg(
        *[(F.sum(F.col(c) * F.col("weight")) / weight).alias(c) for c in ("start_lat", "start_lng")]
    )
    zones = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(centres)], "pickup_zone int, lat double, lng double"
    )
    off = F.hypot(F.col("lat") - F.col("start_lat"), F.col("lng") - F.col("start_lng"))
    checked = zones.join(means, "pickup_zone", "left").select("pickup_zone", off.alias("off"))
    return checked.filter("off IS NULL OR off > 0.001")


@register("i3_fit_zoning_profile")
def i3(spark, sf_dir):
    return fit_zoning(or_partials(spark, sf_dir), lattice_centroids(spark)).profile


@register(
    "e15_kmeans_inertia",
    with_("or_partials", "centroids") + _KMEANS + f"SELECT {exact_sum('d2 * w', '1e9')} AS inertia FROM km_labels",
)
def e15_fitted(spark, sf_dir):
    points = pickup_points(or_partials(spark, sf_dir), lattice_centroids(spark))
    return inertia(points, fit_centres(points))


@register("i5_i6_boosted_trees_scores")
def i5(spark, sf_dir):
    rows = settle(feature_rows(*ev_zoning(spark, sf_dir)))
    cut = F.lit("2024-01-22").cast("date")
    fitted = BoostedTrees(QUICK_TREES).fit(rows.filter(F.col("date") < cut))
    return error_metrics(fitted.predict(rows.filter(F.col("date") >= cut)))


@register(
    "i5_i6_boosted_trees_violations",
    "SELECT CAST(NULL AS VARCHAR) AS violation WHERE false",
)
def i5_checked(spark, sf_dir):
    """What would be wrong with fitted trees: a row without a usable prediction, or errors no
    smaller than those of the overall mean."""
    rows = settle(feature_rows(*ev_zoning(spark, sf_dir)))
    fitted = BoostedTrees(QUICK_TREES).fit(rows)
    scored = fitted.predict(rows).withColumn("mean", F.avg("ride_count").over(Window.partitionBy(F.lit(0))))
    found = scored.agg(
        F.count_if(F.coalesce(F.isnan("prediction"), F.lit(True))).alias("lost"),
        F.sum(F.pow(F.col("ride_count") - F.col("prediction"), F.lit(2))).alias("trees"),
        F.sum(F.pow(F.col("ride_count") - F.col("mean"), F.lit(2))).alias("flat"),
    )
    violations = F.array(
        F.when(F.col("lost") > 0, "a row has no prediction"),
        F.when(F.col("trees") >= F.col("flat"), "the overall mean is as good"),
    )
    return found.select(F.explode(F.array_compact(violations)).alias("violation"))


@register("i7_training_run")
def i7(spark, sf_dir):
    bundle = train(
        or_partials(spark, sf_dir), lattice_centroids(spark), WeekdayMean(), end_month="2001-07"
    )
    made = bundle.metadata
    row = (made["test_month"], made["train_months"], made["eval_train_months"], made["metrics"])
    counts = (made["n_train_rows"], made["n_test_rows"])
    return spark.createDataFrame(
        [row + counts],
        "test_month string, train_months array<string>, eval_train_months array<string>, "
        "metrics map<string,double>, n_train_rows bigint, n_test_rows bigint",
    )


_REFITTED = f""", km_points AS MATERIALIZED (
      SELECT strftime(test_month, '%Y-%m') || '/' || window_months AS fold, pickup_location_id AS p, lat, lng,
        CAST(sum(ride_count) AS BIGINT) AS w
      FROM bt_folds JOIN or_months ON month = train_month JOIN centroids ON location_id = pickup_location_id GROUP BY ALL),
    {kmeans('km_points', [S.N_ZONES])},
    rf_settings AS (SELECT DISTINCT test_month, window_months, CAST(k AS INTEGER) AS n_zones, fold
      FROM bt_folds JOIN km_centres ON fold = strftime(test_month, '%Y-%m') || '/' || window_months),
    rf_maps AS MATERIALIZED (SELECT test_month, window_months, n_zones, location_id AS pickup_location_id, near.z AS pickup_zone
      FROM (SELECT fold, k, location_id, min({{'d2': {squared('p', 'c')}, 'z': c.z}}) AS near
            FROM centroids p CROSS JOIN km_centres c GROUP BY ALL) JOIN rf_settings USING (fold)),
    bt_train AS (SELECT test_month, window_months, n_zones, pickup_zone, hour, isodow(date) AS dow, sum(ride_count) AS rides
      FROM bt_folds JOIN or_months ON month = train_month JOIN rf_maps USING (test_month, window_months, pickup_location_id)
      GROUP BY ALL),
    rf_counts AS (SELECT test_month, window_months, n_zones, pickup_zone, hour, date, sum(ride_count) AS n
      FROM or_months JOIN rf_maps ON test_month = month AND rf_maps.pickup_location_id = or_months.pickup_location_id GROUP BY ALL),
    bt_truth AS (SELECT s.test_month, s.window_months, s.n_zones, z AS pickup_zone, h AS hour, d.date,
        coalesce(n, 0) AS ride_count
      FROM rf_settings s JOIN (SELECT DISTINCT month, date FROM or_months) d ON d.month = s.test_month
        CROSS JOIN range(24) b(h) CROSS JOIN range({S.N_ZONES}) a(z)
        LEFT JOIN rf_counts c ON c.test_month = s.test_month AND c.window_months = s.window_months
          AND c.n_zones = s.n_zones AND c.pickup_zone = z AND c.hour = h AND c.date = d.date),
    backtest AS ({BLOCKS["backtest"][1]})
    SELECT window_months, n_zones, strftime(test_month, '%Y-%m') AS test_month,
      mae, rmse, wape, smallest_zone_share, n_test_rows FROM backtest"""


@register("i8_backtest_refitted_zones", _covered("bt_folds", "bt_days", "centroids") + _REFITTED)
def i8_refitted(spark, sf_dir):
    return X.backtest(
        or_covered(spark, sf_dir),
        lattice_centroids(spark),
        WeekdayMean(),
    )


_LATEST = f""", zc_window AS (SELECT CAST(max(month) - INTERVAL {S.TRAIN_WINDOW_MONTHS - 1} MONTH AS DATE) AS first,
      max(month) AS last FROM or_months),
    km_points AS MATERIALIZED (SELECT '' AS fold, pickup_location_id AS p, lat, lng, CAST(sum(ride_count) AS BIGINT) AS w
      FROM or_months JOIN centroids ON location_id = pickup_location_id
      WHERE month BETWEEN (SELECT first FROM zc_window) AND (SELECT last FROM zc_window) GROUP BY ALL),
    {kmeans('km_points', S.ZONE_COUNT_CANDIDATES)}, {SILHOUETTES}"""


@register(
    "i9_validate_zone_counts",
    _COVERED + _LATEST + f"""
    SELECT CAST(k AS INTEGER) AS k, inertia, silhouette, smallest / CAST(rides AS DOUBLE) AS smallest_zone_share,
      largest / CAST(rides AS DOUBLE) AS largest_zone_share
    FROM (SELECT k, {exact_sum('d2 * w', '1e9')} AS inertia FROM km_labels GROUP BY k) JOIN silhouettes USING (k)
      JOIN (SELECT k, CASE WHEN count(*) < k THEN 0 ELSE min(r) END AS smallest, max(r) AS largest, sum(r) AS rides
            FROM (SELECT k, z, sum(w) AS r FROM km_labels GROUP BY ALL) GROUP BY k) USING (k)""",
)
def i9(spark, sf_dir):
    return X.validate_zone_counts(or_covered(spark, sf_dir), lattice_centroids(spark))


@register("i10_i11_random_search")
def i11(spark, sf_dir):
    def draw(rng):
        return {**X.draw_tree_params(rng), "n_estimators": 2, "num_leaves": 7}

    return X.tune(
        or_covered(spark, sf_dir),
        lattice_centroids(spark),
        n_trials=1,
        n_test_months=1,
        window_months=2,
        n_zones=5,
        current=QUICK_TREES,
        draw=draw,
    )


def _short(rng):
    """A draw whose trees are few and small; what else it drew stays."""
    return {**X.draw_tree_params(rng), "n_estimators": 2, "num_leaves": 7}


@register(
    "i10_i11_search_violations",
    "SELECT CAST(NULL AS VARCHAR) AS violation, CAST(NULL AS VARCHAR) AS trial WHERE false",
)
def i11_checked(spark, sf_dir):
    """What would be wrong with a search over all default folds: a trial that is not scored on
    every one of them, settings outside their range or not those drawn, trials out of order."""
    n_trials, folds = 2, S.BACKTEST_TEST_MONTHS
    partials = or_covered(spark, sf_dir)
    found = settle(
        X.tune(partials, lattice_centroids(spark), n_trials=n_trials, current=QUICK_TREES, draw=_short)
        .withColumn("place", F.monotonically_increasing_id())
    )
    drawn = X.search_trials(n_trials, S.SEED, QUICK_TREES, _short)
    wanted = spark.createDataFrame(
        [(i, name, {k: float(v) for k, v in params.items()}) for i, name, params in drawn],
        "trial_index int, wanted string, drawn map<string,double>",
    )
    beside = wanted.join(found, "trial_index", "left")
    same = F.array_sort(F.map_entries("params")) == F.array_sort(F.map_entries("drawn"))
    by_score = Window.orderBy("wape", "trial_index")  # one row a trial
    ranked = found.withColumn("rank", F.row_number().over(by_score)).withColumn(
        "shown", F.row_number().over(Window.orderBy("place"))
    )
    low_high = {name: (10.0**a, 10.0**b) if kind == "power of ten" else (a, b) for name, (kind, a, b) in S.SEARCH_SPACE.items()}
    draws = spark.createDataFrame(
        [(name, k, float(v)) for i, name, params in X.search_trials(S.TUNING_TRIALS)[1:] for k, v in params.items()],
        "trial string, name string, value double",
    )
    ranges = spark.createDataFrame([(n, float(a), float(b)) for n, (a, b) in low_high.items()], "name string, low double, high double")
    reasons = [
        beside.filter(F.col("trial").isNull() | (F.col("trial") != F.col("wanted"))).select(F.lit("missing").alias("violation"), F.col("wanted").alias("trial")),
        beside.filter(F.col("folds") != folds).select(F.lit("not on every fold"), "trial"),
        beside.filter(~same).select(F.lit("other settings than drawn"), "trial"),
        ranked.filter("rank <> shown").select(F.lit("out of order"), "trial"),
        draws.join(ranges, "name").filter(~F.col("value").between(F.col("low"), F.col("high"))).select(F.lit("out of range"), "trial"),
    ]
    violations = reasons[0]
    for more in reasons[1:]:
        violations = violations.union(more)
    return violations
