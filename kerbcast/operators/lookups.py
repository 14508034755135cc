"""Joins of large tables to lookups with unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a table whose size follows from parameters, up to which it is always broadcast.
SMALL_ROWS = 200_000


def cells_fit_broadcast(n_zones: int) -> bool:
    """Whether a table of one row per zone and hour is small: its size is known."""
    return n_zones * 24 <= SMALL_ROWS


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "inner", small: bool = False
) -> DataFrame:
    """Join facts to a lookup.

    ``small`` tells that the lookup's size follows from parameters; then it is broadcast.
    Otherwise the engine decides by bytes, again once the lookup is computed: a broadcast
    within ``spark.sql.autoBroadcastJoinThreshold``, else a sort-merge join whose skewed
    partitions are split.  Nothing is counted while the plan is built.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return facts.join(F.broadcast(lookup) if small else lookup, keys, how)
