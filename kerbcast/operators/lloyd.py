"""Weighted k-means for many settings at once.

A setting is a fold of points and a number of zones.  Every Lloyd step is one job for all
settings and starts together: points meet the arrays of their fold's centres, and one
aggregate sums weight and coordinates by setting and zone.  The driver holds the centres only,
whose number follows from the settings.  Coordinates are added in whole steps, so centres do
not depend on row order, and a setting whose centres come back unchanged is done.

First centres are a weighted draw without replacement: of the distinct places, those with the
smallest ``-ln(u) / weight``, where u in (0, 1) is a hash of start and place.  Of ``STARTS``
draws the one that ends with the smallest inertia stays, the earlier on ties.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.geo import squared_distance
from kerbcast.session import settle

Centres = list[tuple[float, float]]
Setting = tuple[object, int]

STARTS, MAX_STEPS = 4, 300
#: Coordinates are added in whole steps of this fraction of a unit.
COORDINATE_STEPS = 1e9


def in_steps(value: Column) -> Column:
    return F.rint(value * F.lit(COORDINATE_STEPS)).cast("bigint")


def nearest_of(lat: Column, lng: Column, lats: Column, lngs: Column) -> Column:
    """``struct(d2, zone)`` of the closest of the centres in two array columns, the lowest zone on
    ties."""
    distances = F.zip_with(lats, lngs, lambda y, x: squared_distance(lat, lng, y, x))
    closest = F.array_min(distances)
    return F.struct(
        closest.alias("d2"), (F.array_position(distances, closest) - 1).cast("int").alias("zone")
    )


def places(points: DataFrame) -> DataFrame:
    """The distinct coordinates of each fold with their weight."""
    return points.groupBy("fold", "start_lat", "start_lng").agg(
        F.sum("weight").cast("bigint").alias("weight")
    )


def draw_order(start: Column, seed: int) -> Column:
    """Where a place stands in a start's draw: smaller is earlier."""
    name = F.concat_ws(
        ":", F.lit(str(seed)), start.cast("string"), in_steps(F.col("start_lat")).cast("string"),
        in_steps(F.col("start_lng")).cast("string"),
    )
    hashed = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("bigint")
    return -F.ln((hashed + 0.5) / F.lit(2.0**52)) / F.col("weight")


def first_centres(
    spots: DataFrame, settings: Sequence[Setting], seed: int = S.SEED, starts: int = STARTS
) -> dict[tuple, Centres]:
    """Drawn centres by (fold, k, start).  Raises for a fold with fewer places than zones."""
    most = max(k for _, k in settings)
    rows = spots.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))))
    order = Window.partitionBy("fold", "start").orderBy("draw", "start_lat", "start_lng")
    drawn = (
        rows.withColumn("draw", draw_order(F.col("start"), seed))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most)
        .select("fold", "start", "rank", "start_lat", "start_lng")
        .collect()
    )
    by_draw: dict[tuple, Centres] = {}
    for row in sorted(drawn, key=lambda r: r["rank"]):
        by_draw.setdefault((row["fold"], row["start"]), []).append((row["start_lat"], row["start_lng"]))
    out = {}
    for fold, k in settings:
        for start in range(starts):
            found = by_draw.get((fold, start), [])
            if len(found) < k:
                raise ValueError(f"{k} zones need at least as many distinct points, got {len(found)}")
            out[fold, k, start] = found[:k]
    return out


def with_centres(points: DataFrame, centres: Sequence[tuple[object, object, Centres]]) -> DataFrame:
    """Every point beside ``key, lats, lngs`` of each (key, fold, centres) of its fold.

    Centres are parameters of one expression, so points meet them without a join.
    """
    by_fold: dict[str, list] = {}
    for key, fold, own in centres:
        entry = {"key": key, "lats": [lat for lat, _ in own], "lngs": [lng for _, lng in own]}
        by_fold.setdefault(str(fold), []).append(entry)
    kind = "map<string, array<struct<key: int, lats: array<double>, lngs: array<double>>>>"
    all_centres = F.from_json(F.lit(json.dumps(by_fold)), kind)
    own = F.explode(F.try_element_at(all_centres, F.col("fold").cast("string")))
    return points.withColumn("_own", own).select(*points.columns, "_own.*")


def lloyd_step(spots: DataFrame, centres: dict[tuple, Centres]) -> tuple[dict[tuple, Centres], dict[tuple, float]]:
    """(new centres, inertia of the old ones) of every key (fold, k, start), in one job."""
    keys = list(centres)
    near = nearest_of(F.col("start_lat"), F.col("start_lng"), F.col("lats"), F.col("lngs"))
    weight = F.col("weight").cast("decimal(38,0)")
    sums = (
        with_centres(spots, [(i, key[0], centres[key]) for i, key in enumerate(keys)])
        .select("key", "start_lat", "start_lng", "weight", F.explode(F.array(near)).alias("near"))
        .groupBy("key", F.col("near.zone").alias("zone"))
        .agg(
            F.sum("weight").alias("weight"),
            F.sum((weight * in_steps(F.col("start_lat"))).cast("decimal(38,0)")).cast("double").alias("lat"),
            F.sum((weight * in_steps(F.col("start_lng"))).cast("decimal(38,0)")).cast("double").alias("lng"),
            F.sum(F.rint(F.col("near.d2") * F.col("weight") * F.lit(1e9)).cast("decimal(38,0)")).alias("inertia"),
        )
        .collect()
    )
    moved = {key: list(own) for key, own in centres.items()}
    inertia = dict.fromkeys(keys, 0)
    for row in sums:
        key, weight = keys[row["key"]], row["weight"]
        # A zone that lost all its points is in no row and keeps its centre.
        moved[key][row["zone"]] = (
            row["lat"] / COORDINATE_STEPS / weight,
            row["lng"] / COORDINATE_STEPS / weight,
        )
        inertia[key] += int(row["inertia"])
    return moved, {key: total / 1e9 for key, total in inertia.items()}


def fit_keyed(
    points: DataFrame, settings: Sequence[Setting], seed: int = S.SEED, starts: int = STARTS
) -> dict[Setting, Centres]:
    """Centres of every (fold, k), ordered by coordinates so that zone numbers are repeatable.

    ``points`` holds ``fold, start_lat, start_lng, weight``; a point of weight w counts as w.
    """
    settings = list(dict.fromkeys(settings))
    if not settings:
        return {}
    spots = settle(places(points))
    running = first_centres(spots, settings, seed, starts)
    done: dict[tuple, tuple[float, Centres]] = {}
    for step in range(MAX_STEPS):
        moved, inertia = lloyd_step(spots, running)
        for key, own in moved.items():
            if own == running[key] or step == MAX_STEPS - 1:
                done[key] = inertia[key], own
        running = {key: own for key, own in moved.items() if key not in done}
        if not running:
            break
    best = {}
    for fold, k in settings:
        start = min(range(starts), key=lambda s: (done[fold, k, s][0], s))
        best[fold, k] = sorted(done[fold, k, start][1])
    return best


def labelled(points: DataFrame, centres: dict[Setting, Centres]) -> DataFrame:
    """Every point once for each setting of its fold, with ``k, pickup_zone`` and ``d2``."""
    near = nearest_of(F.col("start_lat"), F.col("start_lng"), F.col("lats"), F.col("lngs"))
    return (
        with_centres(points, [(k, fold, own) for (fold, k), own in centres.items()])
        .select(*points.columns, F.col("key").alias("k"), F.explode(F.array(near)).alias("near"))
        .select(*points.columns, "k", F.col("near.zone").alias("pickup_zone"), F.col("near.d2").alias("d2"))
    )
