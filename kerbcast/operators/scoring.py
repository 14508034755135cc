"""Forecast errors and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.exact import exact_mean, exact_sum
from kerbcast.session import settle

SETTING = ("window_months", "n_zones")


def error_metrics(
    scored: DataFrame,
    keys: Sequence[str] = (),
    truth: str = "ride_count",
    guess: str = "prediction",
) -> DataFrame:
    """MAE, RMSE and WAPE of each group in one aggregate.

    WAPE, total absolute error over total rides, does not depend on how busy a cell is.
    It is NULL for a group without rides; rows without a prediction are left out.
    """
    error = F.col(truth) - F.col(guess)
    scored = scored.filter(error.isNotNull())
    return scored.groupBy(*keys).agg(
        exact_mean(F.abs(error)).alias("mae"),
        F.sqrt(exact_mean(error * error, wide=True)).alias("rmse"),
        F.try_divide(exact_sum(F.abs(error)), F.sum(truth).cast("double")).alias("wape"),
        F.count("*").alias("n_test_rows"),
    )


def first_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, or any if the rows are equal."""
    if not order:
        return rows.dropDuplicates(list(keys))
    others = [name for name in rows.columns if name not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(first).select(*keys, "_row.*")


def common_test_months(results: DataFrame) -> DataFrame:
    """The test months that were run for every setting."""
    settings = results.select(*SETTING).distinct().agg(F.count("*")).scalar()
    runs = results.groupBy("test_month").agg(F.count("*").alias("runs"))
    return runs.filter(F.col("runs") == settings).select("test_month")


def summarize_backtest(results: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Mean scores per setting over the months every setting was run on.

    Averaging each setting over its own months would compare different seasons; where no
    month was run for all, that is an error rather than an empty summary.
    """
    single = settle(first_rows(results, [*SETTING, "test_month"], order))
    common = settle(common_test_months(single))
    if common.isEmpty():
        raise ValueError("no test month was run for every setting; nothing can be compared")
    return (
        single.join(common, "test_month", "left_semi")
        .groupBy(*SETTING)
        .agg(
            F.count_distinct("test_month").alias("test_months"),
            exact_mean("mae").alias("mae"),
            exact_mean("rmse").alias("rmse"),
            exact_mean("wape", 1e9).alias("wape"),
            exact_mean("smallest_zone_share", 1e9).alias("smallest_zone_share"),
        )
    )


def mean_over_folds(scores: DataFrame, keys: Sequence[str] = ("trial",)) -> DataFrame:
    """Mean metrics of each trial over its folds."""
    return scores.groupBy(*keys).agg(
        exact_mean("wape", 1e9).alias("wape"),
        exact_mean("mae").alias("mae"),
        exact_mean("rmse").alias("rmse"),
        F.count("*").alias("folds"),
    )


def best_first(trials: DataFrame, n: int | None = None) -> DataFrame:
    """Trials by WAPE; on ties the earlier trial, so the current settings win."""
    ordered = trials.orderBy("wape", "trial_index")
    return ordered if n is None else ordered.limit(n)
