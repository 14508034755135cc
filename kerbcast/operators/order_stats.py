"""Exact ranks and quantiles without a global sort or an unbounded aggregate state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKETS = 4096
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _bucket(value: Column, low: float | int, high: float | int) -> Column:
    """A number from 0 that never falls as the value rises, 0 for the lowest value alone.

    Whole numbers are cut in whole steps of 38 digits, so no two ids are too close and no
    range too wide; other numbers by halves, so that the range cannot overflow.
    """
    if isinstance(low, int):
        width = -(-(high - low) // _BUCKETS)
        offset = value.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)") - 1
        part = F.floor(offset / F.lit(width).cast("decimal(20,0)"))
    else:
        scale = min(_BUCKETS / max(high / 2 - low / 2, 5e-324), 1.7e308)
        part = F.floor((value / 2 - F.lit(low) / 2) * F.lit(scale))
    part = F.least(F.greatest(part, F.lit(0)), F.lit(_BUCKETS - 1)).cast("int")
    return F.when(value == F.lit(low), 0).otherwise(part + 1)


def _narrowed(df: DataFrame, whole: bool, wanted: dict, ends: dict, weight: str | None) -> dict:
    """One kind of columns: (column, rank) -> (value, rows below it)."""
    size = F.count(F.lit(1)) if weight is None else F.sum("w")
    own = [] if weight is None else [F.col(weight).alias("w")]
    kind = "bigint" if whole else "double"
    low = {key: (*ends[key[0]], 0) for key in wanted}
    found = {}
    while low:
        found |= {key: (a, below) for key, (a, b, below) in low.items() if a == b}
        low = {key: ends_ for key, ends_ in low.items() if key not in found}
        ranges = sorted({(key[0], a, b) for key, (a, b, _) in low.items()})
        if not ranges:
            break
        # Every value goes to the ranges that hold it, all in one scan.
        entries = [
            F.when(
                F.col(name).between(F.lit(a), F.lit(b)),
                F.struct(F.lit(i).alias("range"), _bucket(F.col(name), a, b).alias("bucket"), F.col(name).cast(kind).alias("v")),
            )
            for i, (name, a, b) in enumerate(ranges)
        ]
        cells = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"), *own).groupBy("e.range", "e.bucket")
        counted: dict[int, list] = {}
        for row in cells.agg(size.alias("n"), F.min("e.v").alias("a"), F.max("e.v").alias("b")).collect():
            counted.setdefault(row["range"], []).append((row["bucket"], row["n"], row["a"], row["b"]))
        for key, (a, b, below) in low.items():
            for _, n, first, last in sorted(counted[ranges.index((key[0], a, b))]):
                if below + n >= key[1]:
                    low[key] = first, last, below
                    break
                below += n
    return found


def values_at_ranks(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], weight: str | None = None
) -> dict[tuple[str, int], tuple]:
    """For each column and rank (from 1, among values that are not null): the value of that
    rank and how many values are smaller.  A row stands for as many as its whole ``weight``,
    above 0, if one is named.

    Each pass counts, for all columns and ranks at once, rows in some thousand buckets of
    the range that holds a rank, and goes on with that bucket.  Bucketing is monotone in
    the value, so no rounding can move a row across the answer, and any number of equal
    values is one bucket.  What comes back to the driver is bounded by buckets and ranks.
    """
    names = [name for name in wanted if wanted[name]]
    if not names:
        return {}
    row = df.agg(*[f(F.col(name)) for name in names for f in (F.min, F.max)]).first()
    ends = {name: (row[2 * k], row[2 * k + 1]) for k, name in enumerate(names)}
    whole = {name: isinstance(df.schema[name].dataType, _WHOLE) for name in names}
    found = {}
    for kind in (True, False):
        keys = {(name, rank) for name in names if whole[name] is kind for rank in wanted[name]}
        if keys:
            own = {name: tuple(map(int if kind else float, ends[name])) for name, _ in keys}
            found |= _narrowed(df, kind, keys, own, weight)
    return found


def value_at_rank(df: DataFrame, value: Column, rank: int) -> tuple:
    """The ``rank``-th smallest value (from 1) and how many rows are smaller."""
    return values_at_ranks(df.select(value.alias("v")), {"v": [rank]})["v", rank]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row for each distinct value of each column, with the rows that have it under ``n``;
    the other columns are null there.  One scan, combined before its shuffle."""
    entries = [
        F.struct(*[(F.col(c) if c == name else F.lit(None)).cast(df.schema[c].dataType).alias(c) for c in columns])
        for name in columns
    ]
    values = df.select(F.inline(F.array(*entries)))
    return values.dropna("all").groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], weight: str | None = None
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each column, ignoring missing values; a row counts ``weight``
    times, if that is named."""
    each = F.lit(1) if weight is None else F.col(weight)
    counts = df.agg(
        *[F.coalesce(F.sum(F.when(F.col(name).isNotNull(), each)), F.lit(0)).alias(name) for name in columns]
    ).first()
    wanted: dict[str, list[int]] = {}
    for name in columns:
        places = [p * (counts[name] - 1) for p in probabilities] if counts[name] else []
        wanted[name] = sorted({int(at) + k for at in places for k in (1, 2) if int(at) + k <= counts[name]})
    values = values_at_ranks(df, wanted, weight)
    found: dict[str, list[float | None]] = {}
    for name in columns:
        found[name] = [None] * len(probabilities)
        if not counts[name]:
            continue
        for k, p in enumerate(probabilities):
            at = p * (counts[name] - 1)
            below = int(at)
            low = float(values[name, below + 1][0])
            if at == below:
                found[name][k] = low
            else:
                high = float(values[name, below + 2][0])
                found[name][k] = (below + 1 - at) * low + (at - below) * high
    return found
