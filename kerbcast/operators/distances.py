"""Pair distances of locations, kept in blocks and summed under any number of labelings.

Distances depend on places only, not on zones or weights.  They are computed once: a row of the
store has one point and the distances to all members of one block, in whole steps.  Every
labeling then adds them up with its own zones and weights, in one equi-join on the block;
no pair is a row of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast import settings as S
from kerbcast.functions.exact import exact_sum
from kerbcast.functions.geo import squared_distance
from kerbcast.session import settle

#: Distances are kept in whole steps of this fraction of a coordinate unit.
DISTANCE_STEPS = 1e9


@dataclass(frozen=True)
class DistanceStore:
    """``members``: block, point, place; ``rows``: block, point, steps (by the members' places)."""

    members: DataFrame
    rows: DataFrame
    point: str


def distance_store(
    points: DataFrame, point: str = "pickup_location_id", block_points: int = S.PAIRWISE_BLOCK
) -> DistanceStore:
    """Distances between all points (one row a point: ``point, start_lat, start_lng``)."""
    spots = settle(points.select(point, "start_lat", "start_lng"))
    blocks = max(1, ceil(spots.count() / block_points))
    block = F.pmod(F.hash(point), F.lit(blocks)).alias("block")
    own = F.struct(point, "start_lat", "start_lng")
    packed = spots.groupBy(block).agg(F.sort_array(F.collect_list(own)).alias("all"))
    members = packed.select("block", F.posexplode("all").alias("place", "m")).select(
        "block", F.col(f"m.{point}").alias(point), "place"
    )
    lat, lng = F.col("start_lat"), F.col("start_lng")

    def steps(m: Column) -> Column:
        away = F.sqrt(squared_distance(lat, lng, m["start_lat"], m["start_lng"]))
        return F.rint(away * F.lit(DISTANCE_STEPS)).cast("bigint")

    rows = (
        spots.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .join(packed, "block")
        .select("block", point, F.transform("all", steps).alias("steps"))
    )
    return DistanceStore(settle(members), settle(rows), point)


def labeling_sums(store: DistanceStore, labelings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For every point, cluster and labeling, the weighted distance to the cluster's members,
    in whole steps.  ``labelings`` holds the keys, the point, ``pickup_zone`` and ``weight``."""
    keys, point = list(keys), store.point
    member = F.struct("place", F.col("weight").cast("decimal(38,0)").alias("weight"))
    clusters = (
        labelings.join(store.members, point)
        .groupBy(*keys, "block", F.col("pickup_zone").alias("cluster"))
        .agg(F.collect_list(member).alias("cluster_members"))
    )
    total = F.aggregate(
        "cluster_members",
        F.lit(0).cast("decimal(38,0)"),
        lambda a, m: (a + m["weight"] * F.get("steps", m["place"])).cast("decimal(38,0)"),
    )
    return (
        store.rows.join(clusters, "block")
        .select(*keys, point, "cluster", total.alias("distance"))
        .groupBy(*keys, point, "cluster")
        .agg(F.sum("distance").cast("decimal(38,0)").alias("distance"))
    )


def silhouettes(store: DistanceStore, labelings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean Euclidean silhouette of each labeling, as if points were repeated ``weight`` times.

    Own-cluster distances divide by one less than the cluster's weight, a cluster of a single
    pickup scores zero, and so does a point at distance zero from everything.
    """
    keys, point = list(keys), store.point
    own = labelings.select(*keys, point, "pickup_zone", "weight")
    sizes = own.groupBy(*keys, F.col("pickup_zone").alias("cluster")).agg(
        F.sum("weight").cast("double").alias("cluster_weight")
    )
    joined = (
        labeling_sums(store, own, keys)
        .withColumn("distance", F.col("distance").cast("double") / F.lit(DISTANCE_STEPS))
        .join(sizes, [*keys, "cluster"])
        .join(own, [*keys, point])
    )
    mine = F.col("cluster") == F.col("pickup_zone")
    per_point = joined.groupBy(*keys, point, "weight").agg(
        F.max(F.when(mine, F.col("distance") / F.greatest(F.col("cluster_weight") - 1, F.lit(1.0)))).alias("within"),
        F.max(F.when(mine, F.col("cluster_weight"))).alias("own_weight"),
        F.min(F.when(~mine, F.col("distance") / F.col("cluster_weight"))).alias("nearest"),
    )
    scale = F.greatest("within", "nearest")
    score = F.when((F.col("own_weight") > 1) & (scale > 0), (F.col("nearest") - F.col("within")) / scale)
    weighted = F.coalesce(score, F.lit(0.0)) * F.col("weight")
    return per_point.groupBy(*keys).agg(
        F.try_divide(exact_sum(weighted, 1e9, wide=True), F.sum("weight").cast("double")).alias("silhouette")
    )
