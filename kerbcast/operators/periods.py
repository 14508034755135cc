"""Calendar windows over the months at hand, and rolling-origin folds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast import settings as S
from kerbcast.functions.clock import month_of, month_sequence, months_ending_at, to_month


def months_present(table: DataFrame, time_col: str = "date") -> DataFrame:
    """The distinct months with rows."""
    return table.select(month_of(time_col).alias("month")).distinct()


def calendar(spark: SparkSession, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """Every month from ``first`` to ``last``, inclusive."""
    months = month_sequence(F.lit(to_month(first)), F.lit(to_month(last)))
    return spark.range(1).select(F.explode(months).alias("month"))


def latest_months(present: DataFrame, n: int) -> DataFrame:
    return present.orderBy(F.desc("month")).limit(n)


def window_months(present: DataFrame, last_month: str | dt.date, n_months: int) -> DataFrame:
    """The calendar window of ``n_months`` ending at ``last_month``, each month marked as
    present or not.  A missing month shortens the window; no older month replaces it."""
    last = F.lit(to_month(last_month))
    wanted = present.sparkSession.range(1).select(
        F.explode(months_ending_at(last, F.lit(n_months))).alias("month")
    )
    marked = present.select("month", F.lit(True).alias("is_present"))
    return wanted.join(marked, "month", "left").select(
        "month", F.coalesce("is_present", F.lit(False)).alias("is_present")
    )


def present_window(present: DataFrame, last_month: str | dt.date, n_months: int) -> list[dt.date]:
    """The window's present months, oldest first (at most ``n_months`` dates)."""
    rows = window_months(present, last_month, n_months).filter("is_present").orderBy("month")
    return [row["month"] for row in rows.collect()]


def fold_windows(
    present: DataFrame,
    windows: Sequence[int] = S.BACKTEST_WINDOWS,
    n_test_months: int = S.BACKTEST_TEST_MONTHS,
    gap_months: int = S.EVAL_GAP_MONTHS,
) -> DataFrame:
    """Rolling-origin folds: for each of the latest test months and each window length,
    the training months ending ``gap_months`` earlier.

    One row per training month wanted, with ``is_present`` and the fold's ``is_complete``.
    A window length named twice is one window.
    """
    lengths = F.array(*[F.lit(n) for n in dict.fromkeys(windows)])
    wanted = (
        latest_months(present, n_test_months)
        .select(F.col("month").alias("test_month"), F.explode(lengths).alias("window_months"))
        .withColumn(
            "train_month",
            F.explode(
                months_ending_at(
                    F.add_months("test_month", -gap_months).cast("date"), F.col("window_months")
                )
            ),
        )
    )
    marked = present.select(F.col("month").alias("train_month"), F.lit(True).alias("is_present"))
    fold = Window.partitionBy("test_month", "window_months")
    return (
        wanted.join(marked, "train_month", "left")
        .withColumn("is_present", F.coalesce("is_present", F.lit(False)))
        .withColumn("is_complete", F.min("is_present").over(fold))
        .select("test_month", "window_months", "train_month", "is_present", "is_complete")
    )


def complete_folds(folds: DataFrame) -> DataFrame:
    """Folds whose whole window is present (a backtest never runs a window short)."""
    return folds.filter("is_complete").select("test_month", "window_months", "train_month")


def shortened_folds(folds: DataFrame) -> DataFrame:
    """The present part of every fold's window (tuning and training run it short)."""
    return folds.filter("is_present").select("test_month", "window_months", "train_month")
