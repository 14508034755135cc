"""Reference predictors on zone-hour-day tables, and the splits they are scored on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast.functions.clock import day_of_week, wall_micros
from kerbcast.operators.order_stats import value_at_rank
from kerbcast.operators.scoring import error_metrics
from kerbcast.session import settle

CELL = ("pickup_zone", "hour")
MICROS_PER_HOUR, MICROS_PER_DAY = 3_600_000_000, 86_400_000_000


def with_weekday(daily: DataFrame) -> DataFrame:
    return daily.withColumn("day_of_week", day_of_week("date"))


def cell_mean(train: DataFrame, keys: Sequence[str] = CELL, name: str = "prediction") -> DataFrame:
    """Mean count per cell; integer sums, so any row order gives the same mean."""
    mean = F.sum("ride_count").cast("double") / F.count("*")
    return train.groupBy(*keys).agg(mean.alias(name))


def zone_hour_mean(train: DataFrame, name: str = "prediction") -> DataFrame:
    return cell_mean(train, CELL, name)


def zone_hour_weekday_mean(train: DataFrame, name: str = "prediction") -> DataFrame:
    return cell_mean(with_weekday(train), (*CELL, "day_of_week"), name)


def count_days_before(days: int) -> Column:
    """The same cell's count exactly ``days`` earlier, NULL if that date has no row."""
    cell = Window.partitionBy(*CELL).orderBy(F.unix_date("date")).rangeBetween(-days, -days)
    return F.max("ride_count").over(cell)


def seasonal_naive(daily: DataFrame, days: int = 7, name: str = "prediction") -> DataFrame:
    return daily.withColumn(name, count_days_before(days).cast("double"))


def persistence(daily: DataFrame, name: str = "prediction") -> DataFrame:
    return seasonal_naive(daily, 1, name)


def recency_features(daily: DataFrame, rolling_days: int = 7) -> DataFrame:
    """Last observed count and the mean of the preceding observed days, per cell."""
    cell = Window.partitionBy(*CELL).orderBy("date")
    return daily.withColumns(
        {
            "last_count": F.lag("ride_count", 1).over(cell),
            "rolling_mean": F.avg("ride_count").over(cell.rowsBetween(-rolling_days, -1)),
        }
    )


def train_mean(in_train: Column, *keys: str) -> Column:
    """Mean count of the training rows of each cell, on every row of the cell."""
    cell = Window.partitionBy(*keys)
    rides = F.sum(F.when(in_train, F.col("ride_count"))).over(cell)
    return F.try_divide(rides.cast("double"), F.count_if(in_train).over(cell))


def _all_predictors(daily: DataFrame, first_test_day: dt.date | Column) -> tuple[DataFrame, list[str]]:
    """The test rows with a column for each baseline, and the names of these."""
    cut = F.lit(first_test_day) if isinstance(first_test_day, dt.date) else first_test_day
    in_train = F.col("date") < cut
    predictors = {
        "zone_hour_mean": train_mean(in_train, *CELL),
        "zone_hour_weekday_mean": train_mean(in_train, *CELL, "day_of_week"),
        "seasonal_naive": count_days_before(7).cast("double"),
        "persistence": count_days_before(1).cast("double"),
    }
    return with_weekday(daily).withColumns(predictors).filter(~in_train), list(predictors)


def _each(wide: DataFrame, names: list[str]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(n).alias("predictor"), F.col(n).alias("prediction")) for n in names]
    )
    return wide.select(*CELL, "date", "ride_count", F.inline(pairs))


def baseline_predictions(daily: DataFrame, first_test_day: dt.date | Column) -> DataFrame:
    """All baselines on the test rows, long: one row per predictor and test cell.

    Means use training days only.  Every baseline looks at one zone and hour, so a single
    shuffle by zone and hour serves all four; a window holds one row per date.
    """
    return _each(*_all_predictors(daily, first_test_day))


def shared_baseline_scores(daily: DataFrame, first_test_day: dt.date | Column) -> DataFrame:
    """All baselines on the same rows: the ``n_test_rows`` of all ``n_rows`` test rows that
    every one of them can predict.  A weekday that a cell never saw in training gets the
    cell's mean over all days."""
    wide, names = _all_predictors(daily, first_test_day)
    fallback = F.coalesce("zone_hour_weekday_mean", "zone_hour_mean")
    wide = wide.withColumn("zone_hour_weekday_mean", fallback)
    every = F.lit(True)
    for name in names:
        every = every & F.col(name).isNotNull()
    wide = wide.withColumns({name: F.when(every, F.col(name)) for name in names})
    rows = _each(wide, names)
    sizes = rows.groupBy("predictor").agg(F.count("*").alias("n_rows"))
    return sizes.join(error_metrics(rows, ["predictor"]), "predictor", "left").fillna(0, ["n_test_rows"])


def baseline_scores(daily: DataFrame, first_test_day: dt.date | Column) -> DataFrame:
    return error_metrics(baseline_predictions(daily, first_test_day), ["predictor"])


# --- splits --------------------------------------------------------------------------


def chronological_sides(
    trips: DataFrame, id_col: str, fraction: float = 0.8, time_col: str = "start_time"
) -> DataFrame:
    """Mark the first ``fraction`` of rows in time order as train, the rest as test; rows
    without a time come last.

    Counts by hour find the hour that holds the cut.  A scan pruned to that hour keeps its
    instants and ids, where exact ranks find the instant, then the id among the rows of that
    very instant.  So two scans of the trips do, with no global sort or row numbering.
    """
    clock = wall_micros(F.col(time_col))
    hour = clock - F.pmod(clock, F.lit(MICROS_PER_HOUR))
    in_order = Window.orderBy(F.col("hour").asc_nulls_last())
    # One row an hour passes through the ordering.
    hours = trips.groupBy(hour.alias("hour")).agg(F.count("*").alias("n")).select(
        "hour",
        (F.sum("n").over(in_order) - F.col("n")).alias("before"),
        F.sum("n").over(in_order).alias("upto"),
        F.floor(F.sum("n").over(Window.partitionBy()) * F.lit(fraction)).alias("n_train"),
    )
    cut = hours.where("hour IS NOT NULL AND upto >= n_train").orderBy("hour").first()
    if cut is None:
        return trips.withColumn("side", F.when(clock.isNotNull(), "train").otherwise("test"))
    if cut["n_train"] == 0:
        return trips.withColumn("side", F.lit("test"))
    # Whole days around the hour, in the column's own type, reach the scan.
    kind, day = trips.schema[time_col].dataType, cut["hour"] // MICROS_PER_DAY
    first, last = (F.date_from_unix_date(F.lit(day + d).cast("int")).cast(kind) for d in (-1, 2))
    inside = trips.where((F.col(time_col) >= first) & (F.col(time_col) < last)).where(hour == F.lit(cut["hour"]))
    held = settle(inside.select(clock.alias("clock"), F.col(id_col).alias("id")))
    rank = cut["n_train"] - cut["before"]
    instant, earlier = value_at_rank(held, F.col("clock"), rank)
    last_id, _ = value_at_rank(held.where(F.col("clock") == F.lit(instant)), F.col("id"), rank - earlier)
    in_train = (clock < F.lit(instant)) | (
        (clock == F.lit(instant)) & (F.col(id_col) <= F.lit(last_id))
    )
    return trips.withColumn("side", F.when(in_train, "train").otherwise("test"))


def split_diagnosis(sided: DataFrame, n_zones: int) -> DataFrame:
    """Per side: rows, distinct days, and the mean zone-hour count, raw and per day.

    ``sided`` holds ``side, pickup_zone, hour, start_time``.  Raw means differ with the
    days a side covers; daily rates do not.
    """
    per_day = (
        sided.groupBy("side", F.col("start_time").cast("date").alias("date"))
        .agg(F.count("*").alias("rides"))
        .groupBy("side")
        .agg(F.sum("rides").alias("n_rows"), F.count("*").alias("n_days"))
    )
    cells = F.lit(n_zones * 24)
    return per_day.select(
        "side",
        "n_rows",
        "n_days",
        (F.col("n_rows") / cells).alias("mean_ride_count"),
        (F.col("n_rows") / cells / F.col("n_days")).alias("mean_daily_ride_count"),
    )


def date_bucket(date: Column, buckets: int = 100) -> Column:
    """A stable pseudo-random bucket of a date."""
    digest = F.substring(F.md5(F.date_format(date, "yyyy-MM-dd").cast("binary")), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def random_day_sides(daily: DataFrame, test_share: float = 0.2) -> DataFrame:
    """Whole days dealt to train or test by a hash of the date."""
    is_test = date_bucket(F.col("date")) < int(test_share * 100)
    return daily.withColumn("side", F.when(is_test, "test").otherwise("train"))


def split_scores(sided: DataFrame) -> DataFrame:
    """Score the zone-hour-weekday mean of the train side on the test side."""
    prediction = train_mean(F.col("side") == "train", *CELL, "day_of_week")
    scored = with_weekday(sided).withColumn("prediction", prediction)
    return error_metrics(scored.filter("side = 'test'"))


def date_tiles(daily: DataFrame, n_folds: int) -> DataFrame:
    """The dates present cut into ``n_folds + 1`` even tiles: ``date, tile``.

    Only the distinct dates pass through the ordering.
    """
    tile = F.ntile(n_folds + 1).over(Window.orderBy("date"))
    return daily.select("date").distinct().withColumn("tile", tile)


def expanding_folds(daily: DataFrame, n_folds: int) -> DataFrame:
    """Expanding-window folds: ``fold, date, role``.

    Fold i trains on the tiles up to i and is tested on tile i + 1.
    """
    folds = date_tiles(daily, n_folds).withColumn(
        "fold", F.explode(F.sequence(F.greatest(F.col("tile") - 1, F.lit(1)), F.lit(n_folds)))
    )
    role = F.when(F.col("tile") <= F.col("fold"), "train").otherwise("test")
    return folds.select(F.col("fold").cast("int").alias("fold"), "date", role.alias("role"))


def expanding_fold_scores(daily: DataFrame, n_folds: int) -> DataFrame:
    """Zone-hour-weekday mean scored on every expanding fold, as one query.

    Training rows are reduced to sums per tile and cell before they are repeated for the
    folds that contain the tile.
    """
    daily = settle(daily)
    tiled = with_weekday(daily).join(date_tiles(daily, n_folds), "date")
    keys = ["fold", *CELL, "day_of_week"]
    sums = (
        tiled.filter(F.col("tile") <= n_folds)
        .groupBy("tile", *CELL, "day_of_week")
        .agg(F.sum("ride_count").alias("rides"), F.count("*").alias("days"))
    )
    means = (
        sums.withColumn("fold", F.explode(F.sequence("tile", F.lit(n_folds))))
        .groupBy(*keys)
        .agg((F.sum("rides").cast("double") / F.sum("days")).alias("prediction"))
    )
    tests = tiled.filter(F.col("tile") > 1).withColumn("fold", F.col("tile") - 1)
    return error_metrics(tests.join(means, keys, "left"), ["fold"])
