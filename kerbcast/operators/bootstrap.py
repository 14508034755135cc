"""Day-block bootstrap of the mean absolute error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast.functions.exact import exact_sum
from kerbcast.session import settle


def daily_errors(scored: DataFrame, truth: str = "ride_count", guess: str = "prediction") -> DataFrame:
    """Absolute error and row count of each test day."""
    error = F.abs(F.col(truth) - F.col(guess))
    return (
        scored.filter(error.isNotNull())
        .groupBy("date")
        .agg(exact_sum(error).alias("abs_error"), F.count("*").alias("n"))
    )


def _draw(replicate: Column, slot: Column, n_days: Column) -> Column:
    """Which day (from 1) a slot of a replicate takes: a hash, so a rerun repeats it."""
    text = F.concat_ws(":", replicate.cast("string"), slot.cast("string"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, n_days) + 1


def bootstrap_replicates(errors: DataFrame, replicates: int = 2000) -> DataFrame:
    """MAE of each resample of whole days: ``replicate, mae``.

    ``errors`` has one row per day.  Only its days are numbered in one ordering; the
    resamples are generated rows joined to them by day number.
    """
    return _replicates(settle(errors), replicates)


def _replicates(errors: DataFrame, replicates: int) -> DataFrame:
    numbered = errors.withColumns(
        {
            "day_no": F.row_number().over(Window.orderBy("date")).cast("bigint"),
            "n_days": F.count("*").over(Window.partitionBy(F.lit(0))),
        }
    )
    slots = numbered.select(
        F.col("day_no").alias("slot"),
        "n_days",
        F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"),
    )
    drawn = slots.select(
        "replicate", _draw(F.col("replicate"), F.col("slot"), F.col("n_days")).alias("day_no")
    )
    return (
        drawn.join(numbered.select("day_no", "abs_error", "n"), "day_no")
        .groupBy("replicate")
        .agg((exact_sum("abs_error") / F.sum("n")).alias("mae"))
    )


def mae_interval(errors: DataFrame, replicates: int = 2000) -> DataFrame:
    """The central 95 % of the replicates, next to the MAE itself."""
    errors = settle(errors)
    spread = _replicates(errors, replicates).agg(
        F.percentile("mae", F.lit(0.025)).alias("mae_low"),
        F.percentile("mae", F.lit(0.975)).alias("mae_high"),
    )
    overall = errors.agg(exact_sum("abs_error") / F.sum("n")).scalar()
    return spread.select(overall.alias("mae"), "mae_low", "mae_high")
