"""Scans of published trip records.

Curated trips live in one Parquet table laid out as ``month=YYYY-MM``, so a month or a
window of months is read by partition pruning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.clock import to_month


def _number(name: str) -> Column:
    """As double; not-a-number counts as missing, because Spark orders NaN above every
    limit and would call it implausibly large."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def normalize_trips(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The six columns the jobs use, renamed, with plain numbers.

    ``keep`` names extra columns to carry along, such as a row id or the partition
    month.  Everything else is pruned from the scan.
    """
    numbers = {"trip_distance", "fare_amount"}
    columns = [
        (_number(source) if source in numbers else F.col(source)).alias(target)
        for source, target in S.RAW_COLUMNS.items()
    ]
    return raw.select(*columns, *keep)


def scan_trips(
    spark: SparkSession,
    table_path: str,
    months: Iterable[str | dt.date] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Trips of the given months (all, if none are named) from the curated table."""
    raw = spark.read.option("basePath", table_path).parquet(table_path)
    if months is not None:
        names = [to_month(month).strftime("%Y-%m") for month in months]
        raw = raw.filter(F.col("month").cast("string").isin(names))
    return normalize_trips(raw, keep)
