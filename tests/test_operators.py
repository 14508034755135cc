import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbcast.functions.exact import exact_sum
from kerbcast.functions.clock import parse_month, shift_month, to_month
from kerbcast.functions.geo import great_circle_km, nearest_centre
from kerbcast.operators import baselines, bootstrap, quality, scoring, zoning
from kerbcast.operators.lookups import lookup_join
from kerbcast.operators.order_stats import exact_quantiles, value_at_rank, value_counts, values_at_ranks
from kerbcast.operators.periods import fold_windows, complete_folds, present_window, window_months
from kerbcast.operators.polygons import polygon_centroids

POINTS = "pickup_location_id int, start_lat double, start_lng double, weight bigint"


def months_table(spark, names):
    return spark.createDataFrame([(to_month(n),) for n in names], "month date")


# --- joins ---------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_lookups_join_the_same_whether_broadcast_or_not(spark, how, threshold):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"),
        (F.col("id") % 2).alias("copy"),
    )
    lookup = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = lookup_join(facts, lookup, "k", how)
        hinted = lookup_join(facts, lookup, "k", how, small=True)
        rows = sorted(map(str, joined.collect()))
        assert rows == sorted(map(str, hinted.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert len(rows) == sum(1 for i in range(3000) if how == "left" or i % 3 == 0 or i % 50 < 40)


# --- ranks and quantiles -------------------------------------------------------------


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=60), data=st.data())
def test_value_at_rank_matches_sorting(spark, values, data):
    rank = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    found, smaller = value_at_rank(df, F.col("x"), rank)
    ordered = sorted(values)
    assert found == ordered[rank - 1]
    assert smaller == sum(v < found for v in values)


def test_ranks_of_neighbouring_and_extreme_numbers(spark):
    ids = [2**60, 2**60 + 1, 2**60 + 2, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in ids], "x bigint")
    found = values_at_ranks(df, {"x": [1, 2, 3, 4, 5]})
    assert [found["x", r] for r in range(1, 6)] == [(v, k) for k, v in enumerate(sorted(ids))]
    doubles = [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-320, 1.0, math.nextafter(1.0, 2.0)]
    df = spark.createDataFrame([(v,) for v in doubles], "x double")
    found = values_at_ranks(df, {"x": list(range(1, 8))})
    assert [found["x", r][0] for r in range(1, 8)] == sorted(doubles)


def test_exact_quantiles_equal_the_built_in_percentile(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 50) for _ in range(700)] + [1.25] * 400
    df = spark.createDataFrame([(v, int(v), None) for v in values] + [(None, None, None)], "x double, y int, z double")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(df, ["x", "y", "z"], wanted)
    for name in ("x", "y"):
        assert found[name] == df.agg(F.percentile(name, F.array(*map(F.lit, wanted)))).first()[0]
    assert found["z"] == [None] * 5


def test_quantiles_of_counted_values_are_those_of_the_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 0.5, 1.25, rng.gauss(0, 9)]), rng.choice([None, 3, 4, 2**60]), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "x double, y bigint, z double")
    counted = value_counts(df, ["x", "y", "z"])
    assert counted.agg(F.sum("n")).first()[0] == sum(v is not None for row in rows for v in row)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    assert exact_quantiles(counted, ["x", "y", "z"], wanted, "n") == exact_quantiles(df, ["x", "y", "z"], wanted)


def test_outlier_shares_with_missing_and_equal_coordinates(spark):
    rows = [(1.0, None)] * 8 + [(2.0, None), (90.0, None), (None, None)]
    df = spark.createDataFrame(rows, "start_lat double, end_lat double")
    found = quality.iqr_outlier_shares(df, ["start_lat", "end_lat"]).collect()
    assert [tuple(r) for r in found] == [("start_lat", 1.0, 1.0, 2, 0.2)]
    assert quality.iqr_outlier_shares(df.limit(0), ["start_lat", "end_lat"]).collect() == []


def test_sums_of_huge_weights(spark):
    df = spark.createDataFrame([(3e12, 1.5), (1.0, 2.0)], "weight double, score double")
    total = df.agg(exact_sum(F.col("weight") * F.col("score"), 1e9, wide=True)).first()[0]
    assert total == 4.5e12 + 2


def test_chronological_split_breaks_ties_by_id(spark):
    at = dt.datetime(2024, 1, 1, 12)
    rows = [(i, at + dt.timedelta(seconds=i // 40)) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, start_time timestamp_ntz")
    sided = baselines.chronological_sides(df, "id", 0.55)
    train = sorted(r["id"] for r in sided.filter("side = 'train'").collect())
    assert train == list(range(55))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("fraction", [0.0, 0.004, 0.3, 0.5, 0.8, 1.0])
def test_chronological_split_equals_numbered_rows(spark, fraction, kind):
    rng = random.Random(9)
    start = dt.datetime(1969, 12, 31, 22)
    times = [start + dt.timedelta(minutes=rng.choice([0, 59, 60, rng.randrange(4000)]), microseconds=rng.choice([0, 999_999])) for _ in range(250)]
    rows = [(i, t) for i, t in enumerate(times)] + [(900, None), (901, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id bigint, start_time timestamp_ntz").withColumn("start_time", F.col("start_time").cast(kind))
    ordered = sorted((t, i) for i, t in rows if t is not None)
    expected = {i for _, i in ordered[: int(len(rows) * fraction)]}
    sided = baselines.chronological_sides(df, "id", fraction)
    assert sided.count() == len(rows)
    assert {r["id"] for r in sided.filter("side = 'train'").collect()} == expected
    assert baselines.chronological_sides(df.limit(0), "id", fraction).collect() == []


# --- periods -------------------------------------------------------------------------


def test_a_missing_month_shortens_the_window(spark):
    present = months_table(spark, ["2026-03", "2026-05", "2026-08"])
    assert present_window(present, "2026-08", 4) == [dt.date(2026, 5, 1), dt.date(2026, 8, 1)]
    marked = {r["month"].month: r["is_present"] for r in window_months(present, "2026-08", 4).collect()}
    assert marked == {5: True, 6: False, 7: False, 8: True}


def test_runnable_folds(spark):
    present = months_table(spark, [f"2026-0{m}" for m in range(4, 9)])
    folds = complete_folds(fold_windows(present, [1, 2, 3, 3], 2, 2))
    found = {(r["window_months"], r["test_month"].month) for r in folds.collect()}
    assert found == {(1, 7), (2, 7), (1, 8), (2, 8), (3, 8)}
    last = folds.groupBy("test_month").agg(F.max("train_month").alias("m")).collect()
    assert all(shift_month(r["m"], 2) == r["test_month"] for r in last)


def test_month_text_is_normalized(spark):
    df = spark.createDataFrame([("2026-8",), ("2026-08",)], "m string")
    assert df.select(parse_month("m").alias("d")).distinct().collect()[0]["d"] == dt.date(2026, 8, 1)
    assert to_month("2026-8") == to_month("2026-08")


# --- scoring -------------------------------------------------------------------------

RESULTS = (
    "window_months int, n_zones int, test_month string, mae double, rmse double, wape double, "
    "smallest_zone_share double"
)


def test_error_metrics(spark):
    df = spark.createDataFrame([(10, 12.0), (0, 1.0), (5, 5.0), (9, None)], "ride_count bigint, prediction double")
    row = scoring.error_metrics(df).first()
    assert row["mae"] == pytest.approx(1.0) and row["wape"] == pytest.approx(0.2)
    assert row["rmse"] == pytest.approx(math.sqrt(5 / 3)) and row["n_test_rows"] == 3


def test_wape_without_rides_is_missing(spark):
    df = spark.createDataFrame([(0, 1.0)], "ride_count bigint, prediction double")
    assert scoring.error_metrics(df).first()["wape"] is None


def test_summary_uses_months_every_setting_ran(spark):
    rows = [
        (3, 20, "2026-07", 1.0, 1.0, 0.1, 0.01),
        (3, 20, "2026-07", 1.0, 1.0, 0.1, 0.01),
        (3, 20, "2026-08", 3.0, 3.0, 0.3, 0.03),
        (6, 20, "2026-08", 2.0, 2.0, 0.2, 0.02),
    ]
    found = scoring.summarize_backtest(spark.createDataFrame(rows, RESULTS)).orderBy("window_months")
    assert [(r["window_months"], r["test_months"], r["mae"]) for r in found.collect()] == [
        (3, 1, 3.0),
        (6, 1, 2.0),
    ]
    apart = spark.createDataFrame([rows[0], rows[3]], RESULTS)
    with pytest.raises(ValueError, match="nothing can be compared"):
        scoring.summarize_backtest(apart)
    with pytest.raises(ValueError, match="nothing can be compared"):
        scoring.summarize_backtest(apart.limit(0))


def test_ties_keep_the_earlier_trial(spark):
    trials = spark.createDataFrame([(1, 0.2), (0, 0.2), (2, 0.1)], "trial_index int, wape double")
    assert [r["trial_index"] for r in scoring.best_first(trials).collect()] == [2, 0, 1]


# --- baselines -----------------------------------------------------------------------


def test_predictors_on_the_same_rows(spark):
    """Two weeks of one cell; a second, one row of which all predict, on a weekday not seen in
    training; a third without training days."""
    first = dt.date(2026, 6, 1)
    rows = [(0, 7, first + dt.timedelta(days=d), 3 * d % 7) for d in range(14)]
    rows += [(1, 7, first + dt.timedelta(days=d), d) for d in (6, 8, 14, 15)]
    rows += [(2, 7, first + dt.timedelta(days=d), 9) for d in (8, 9)]
    daily = spark.createDataFrame(rows, "pickup_zone int, hour int, date date, ride_count long")
    found = {
        r["predictor"]: r
        for r in baselines.shared_baseline_scores(daily, first + dt.timedelta(days=7)).collect()
    }
    assert len(found) == 4
    assert {(r["n_rows"], r["n_test_rows"]) for r in found.values()} == {(12, 8)}
    weekday = [abs(3 * d % 7 - 3 * (d - 7) % 7) for d in range(7, 14)] + [15 - 6]
    assert found["zone_hour_weekday_mean"]["mae"] == pytest.approx(sum(weekday) / 8)


@pytest.fixture(scope="module")
def daily(spark):
    rows = [
        (z, h, dt.date(2024, 1, 1) + dt.timedelta(days=d), (z * 7 + h * 3 + d * d) % 11)
        for z in range(2)
        for h in (8, 9)
        for d in range(21)
        if d != 12
    ]
    return spark.createDataFrame(rows, "pickup_zone int, hour int, date date, ride_count bigint")


def test_naive_predictors_look_back_by_date(daily):
    counts = {(r["pickup_zone"], r["hour"], r["date"]): r["ride_count"] for r in daily.collect()}
    for days, frame in ((7, baselines.seasonal_naive(daily)), (1, baselines.persistence(daily))):
        for row in frame.collect():
            key = (row["pickup_zone"], row["hour"], row["date"] - dt.timedelta(days=days))
            assert row["prediction"] == counts.get(key)


def test_baselines_match_separate_means(daily):
    cut = dt.date(2024, 1, 15)
    train = daily.filter(F.col("date") < F.lit(cut))
    test = baselines.with_weekday(daily.filter(F.col("date") >= F.lit(cut)))
    together = baselines.baseline_predictions(daily, cut)
    for name, means, keys in (
        ("zone_hour_mean", baselines.zone_hour_mean(train), ["pickup_zone", "hour"]),
        (
            "zone_hour_weekday_mean",
            baselines.zone_hour_weekday_mean(train),
            ["pickup_zone", "hour", "day_of_week"],
        ),
    ):
        expected = test.join(means, keys).select("pickup_zone", "hour", "date", "prediction")
        found = together.filter(F.col("predictor") == name).select(expected.columns)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_recency_features_use_earlier_days_only(daily):
    rows = baselines.recency_features(daily, 3).filter("pickup_zone = 0 and hour = 8")
    ordered = rows.orderBy("date").collect()
    assert ordered[0]["last_count"] is None and ordered[0]["rolling_mean"] is None
    counts = [r["ride_count"] for r in ordered]
    for i in range(1, len(ordered)):
        assert ordered[i]["last_count"] == counts[i - 1]
        assert ordered[i]["rolling_mean"] == pytest.approx(np.mean(counts[max(0, i - 3) : i]))


def test_expanding_folds_never_train_on_later_days(daily):
    folds = baselines.expanding_folds(daily, 3).collect()
    for fold in (1, 2, 3):
        train = [r["date"] for r in folds if r["fold"] == fold and r["role"] == "train"]
        test = [r["date"] for r in folds if r["fold"] == fold and r["role"] == "test"]
        assert train and test and max(train) < min(test)


def test_expanding_fold_scores_match_fold_by_fold(daily):
    scores = {r["fold"]: r for r in baselines.expanding_fold_scores(daily, 3).collect()}
    roles = baselines.expanding_folds(daily, 3)
    for fold in (1, 2, 3):
        one = daily.join(roles.filter(F.col("fold") == fold), "date")
        means = baselines.zone_hour_weekday_mean(one.filter("role = 'train'"))
        keys = ["pickup_zone", "hour", "day_of_week"]
        test = baselines.with_weekday(one.filter("role = 'test'")).join(means, keys, "left")
        assert scores[fold]["mae"] == scoring.error_metrics(test).first()["mae"]


def test_bootstrap_interval_is_repeatable_and_covers_the_mean(spark):
    rows = [(dt.date(2024, 1, 1 + d), float(40 + d * 3), 24) for d in range(20)]
    errors = spark.createDataFrame(rows, "date date, abs_error double, n bigint")
    first, second = (bootstrap.mae_interval(errors, 300).first() for _ in range(2))
    assert first == second
    assert first["mae_low"] < first["mae"] < first["mae_high"]
    assert bootstrap.bootstrap_replicates(errors, 300).count() == 300


# --- quality and geometry ------------------------------------------------------------


def test_duplicates_and_spans(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 5.0), (2, -1.0), (3, 0.0)], "a int, span double")
    row = quality.duplicate_and_span_counts(df, ["a", "span"], "span").first()
    assert tuple(row) == (5, 2, 2)


def test_great_circle(spark):
    row = spark.range(1).select(
        great_circle_km(F.lit(40.7128), F.lit(-74.0060), F.lit(51.5074), F.lit(-0.1278)).alias("km")
    )
    assert row.first()["km"] == pytest.approx(5570, abs=5)


@pytest.mark.parametrize("n", [1, 5, 40])
def test_nearest_centre_takes_the_lowest_on_ties(spark, n):
    centres = [(float(i % 5), float(i // 5)) for i in range(n)]
    points = [(x / 2, y / 2) for x in range(10) for y in range(10)] + [(None, 1.0)]
    df = spark.createDataFrame(points, "lat double, lng double")
    for row in df.withColumn("c", nearest_centre(F.col("lat"), F.col("lng"), centres)).collect():
        if row["lat"] is None:
            assert row["c"]["zone"] is None
            continue
        d2 = [(row["lat"] - a) ** 2 + (row["lng"] - b) ** 2 for a, b in centres]
        assert row["c"]["zone"] == int(np.argmin(d2))


def area_and_centre(points):
    """Signed area and centre of a closed outline, by the shoelace formula."""
    pairs = list(zip(points, points[1:], strict=False))
    cross = [a * d - c * b for (a, b), (c, d) in pairs]
    area = sum(cross) / 2
    return area, *(
        sum((p[k] + q[k]) * w for (p, q), w in zip(pairs, cross, strict=True)) / 6 / area for k in (0, 1)
    )


def outline(rng, x, y, reach, corners, clockwise=False):
    """A closed outline around (x, y), no corner further away than ``reach``."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    points = [(x + rng.uniform(0.6, 1) * reach * math.cos(t), y + rng.uniform(0.6, 1) * reach * math.sin(t)) for t in turns]
    points = points[::-1] if clockwise else points
    return [*points, points[0]]


def test_polygon_centroids_equal_plain_geometry(spark):
    """Random outlines, some with a hole, some of several shapes."""
    rng = random.Random(12)
    shapes, expected = [], {}
    for place in range(6):
        parts = []
        for shape in range(1 + place % 3):
            x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
            rings = [outline(rng, x, y, 9.0, 11)]
            if place % 2:
                rings.append(outline(rng, x, y, 1.5, 7, clockwise=True))
            parts += rings
            shapes.append((place, f"Area {place}-{shape}", 10 * place + shape, rings))
        weighted = [area_and_centre(r) for r in parts]
        total = sum(a for a, *_ in weighted)
        expected[place] = [sum(a * c[k] for a, *c in weighted) / total for k in (0, 1)]
    rows = [
        (i, name, shape, r, seq, x, y)
        for i, name, shape, rings in shapes
        for r, points in enumerate(rings)
        for seq, (x, y) in enumerate(points)
    ]
    vertices = spark.createDataFrame(
        rows, "id int, name string, shape int, ring int, seq int, x double, y double"
    )
    found = {r["id"]: r for r in polygon_centroids(vertices).collect()}
    assert found.keys() == expected.keys()
    for place, centre in expected.items():
        assert (found[place]["x"], found[place]["y"]) == pytest.approx(centre, rel=1e-6, abs=1e-6)
        assert found[place]["name"] == f"Area {place}-0"


# --- zones ---------------------------------------------------------------------------


def test_centres_are_weighted_means_of_their_points(spark):
    rng = random.Random(21)
    towns = [(-6.0, 2.0), (3.0, 8.0), (5.0, -7.0)]
    rows = [(i, x + rng.gauss(0, 0.3), y + rng.gauss(0, 0.3), rng.randint(1, 9)) for i, (x, y) in enumerate(towns * 8)]
    points = spark.createDataFrame(rows, POINTS)
    centres = zoning.fit_centres(points, 3)
    assert centres == sorted(centres)
    for x, y in centres:
        own = [r for r in rows if min(centres, key=lambda c: math.hypot(r[1] - c[0], r[2] - c[1])) == (x, y)]
        weight = sum(r[3] for r in own)
        assert (x, y) == pytest.approx([sum(r[k] * r[3] for r in own) / weight for k in (1, 2)])
    repeated = points.withColumn("i", F.explode(F.sequence(F.lit(1), "weight"))).drop("weight", "i")
    assert zoning.fit_centres(repeated, 3, weight=None) == [pytest.approx(c) for c in centres]


def test_centres_do_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    rows = [(i, rng.random(), rng.random(), rng.randint(1, 50)) for i in range(60)]
    points = spark.createDataFrame(rows, POINTS)
    assert zoning.fit_centres(points.repartition(7), 6) == zoning.fit_centres(points.coalesce(2), 6)


def test_too_few_points_are_refused(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 1), (2, 0.0, 0.0, 3)], POINTS)
    with pytest.raises(ValueError, match="distinct points"):
        zoning.fit_centres(points, 2)


def brute_silhouette(rows):
    """Of the data set in which every point is repeated ``weight`` times."""
    points = [(x, y, c) for _, x, y, w, c in rows for _ in range(w)]
    scores = []
    for i, (x, y, c) in enumerate(points):
        distances = {}
        for j, (u, v, d) in enumerate(points):
            if i != j:
                distances.setdefault(d, []).append(math.hypot(x - u, y - v))
        others = [np.mean(ds) for d, ds in distances.items() if d != c]
        if c not in distances:
            scores.append(0.0)
            continue
        a, b = np.mean(distances[c]), min(others)
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


LONELY = [(1, 2.5, -1.0, 3, 0), (2, 3.0, 1.5, 1, 0), (3, -4.0, 0.5, 1, 1), (4, 2.0, 0.0, 2, 0)]
_rng = random.Random(11)
CLOUD = [
    (i, _rng.gauss(c, 0.6), _rng.gauss(-c, 0.6), _rng.randint(1, 4), c)
    for i, c in enumerate([i % 3 for i in range(40)])
]


@pytest.mark.parametrize("rows", [LONELY, CLOUD], ids=["lonely", "cloud"])
@pytest.mark.parametrize("block", [5, 1024])
def test_weighted_silhouette_matches_brute_force(spark, rows, block):
    points = spark.createDataFrame(rows, POINTS + ", pickup_zone int")
    found = zoning.weighted_silhouette(points, block_points=block).first()[0]
    assert found == pytest.approx(brute_silhouette(rows), abs=1e-7)


def test_summed_distances_are_exact_in_every_tile(spark, monkeypatch):
    monkeypatch.setattr(zoning, "_TILE", 7)
    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random(), rng.randint(1, 9), rng.choice([None, 0, 1, 2])) for i in range(60)]
    rows += [(60, 0.1, 0.2, 10**9, 3), (61, 90.1, 0.2, 10**9, 3), (62, None, 0.5, 2, 4), (62, 0.3, 0.3, 1, 0)]
    found = zoning.summed_distances(spark.createDataFrame(rows, POINTS + ", pickup_zone int"), block_points=1000)
    steps = {}
    for point, x, y, weight, zone in rows:
        for _, u, v, w, cluster in rows:
            away = None if None in (x, u) else round(w * math.sqrt((x - u) * (x - u) + (y - v) * (y - v)) * 1e9)
            steps.setdefault((point, zone, weight, cluster), []).append(away)
    expected = {key: None if None in all_ else sum(all_) / 1e9 for key, all_ in steps.items()}
    assert {tuple(r)[:4]: r["distance"] for r in found.collect()} == expected
    assert "Join" not in found._jdf.queryExecution().toString()  # no point is sent to each block


def test_empty_zones_share_zero(spark, make_partials):
    partials = make_partials([(1, "2026-08-01", 8, 30, 0.0, 0, 0.0, 0), (2, "2026-08-01", 8, 10, 0.0, 0, 0.0, 0)])
    zones = spark.createDataFrame([(1, 0), (2, 2)], "pickup_location_id int, pickup_zone int")
    shares = zoning.zone_rides(partials, zones, 3)
    assert {r["pickup_zone"]: r["share"] for r in shares.collect()} == {0: 0.75, 1: 0.0, 2: 0.25}
    row = zoning.share_extremes(shares).first()
    assert tuple(row) == (0.0, 0.75)
