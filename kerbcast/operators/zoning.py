"""Pickup zones: weighted k-means over locations, and its quality scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbcast import settings as S
from kerbcast.functions.exact import exact_sum
from kerbcast.functions.geo import nearest_centre
from kerbcast.operators.grid import with_zone
from kerbcast.operators.lloyd import fit_keyed

Centres = Sequence[tuple[float, float]]
# Distances are added in whole steps of this fraction of a coordinate unit.
_DISTANCE_STEPS = 1e9
#: Points whose sums a task holds, and distances that it computes at a time.
_TILE, _WIDE = 4096, 1 << 15


def pickup_points(partials: DataFrame, centroids: DataFrame) -> DataFrame:
    """Centre points of the locations that had pickups, weighted by rides."""
    rides = partials.groupBy("pickup_location_id").agg(F.sum("ride_count").alias("weight"))
    points = centroids.select(
        F.col("location_id").alias("pickup_location_id"),
        F.col("lat").alias("start_lat"),
        F.col("lng").alias("start_lng"),
    )
    return points.join(rides, "pickup_location_id")


def locations_with_pickups(centroids: DataFrame, partials: DataFrame) -> DataFrame:
    seen = partials.select(F.col("pickup_location_id").alias("location_id")).distinct()
    return centroids.join(seen, "location_id", "left_semi")


def fit_centres(
    points: DataFrame, n_zones: int = S.N_ZONES, seed: int = S.SEED, weight: str | None = "weight"
) -> list[tuple[float, float]]:
    """K-means centres, ordered by coordinates so that zone numbers are repeatable.

    A point with weight w counts as w pickups, so the input is one row per location
    however many trips there were.
    """
    weights = F.lit(1) if weight is None else F.col(weight)
    rows = points.select(F.lit(0).alias("fold"), "start_lat", "start_lng", weights.alias("weight"))
    return fit_keyed(rows, [(0, n_zones)], seed)[0, n_zones]


def assign_zones(points: DataFrame, centres: Centres) -> DataFrame:
    """Attach the nearest centre's number as ``pickup_zone``: a narrow projection."""
    nearest = nearest_centre(F.col("start_lat"), F.col("start_lng"), centres)
    return points.withColumn("pickup_zone", nearest["zone"])


def zone_map(centroids: DataFrame, centres: Centres) -> DataFrame:
    """``pickup_location_id, pickup_zone`` for every location, with pickups or not."""
    points = centroids.select(
        F.col("location_id").alias("pickup_location_id"),
        F.col("lat").alias("start_lat"),
        F.col("lng").alias("start_lng"),
    )
    return assign_zones(points, centres).select("pickup_location_id", "pickup_zone")


def inertia(points: DataFrame, centres: Centres) -> DataFrame:
    """Weighted squared distance of points to their own centre."""
    nearest = nearest_centre(F.col("start_lat"), F.col("start_lng"), centres)
    return points.agg(exact_sum(nearest["d2"] * F.col("weight"), 1e9, wide=True).alias("inertia"))


def zone_rides(partials: DataFrame, zones: DataFrame, n_zones: int) -> DataFrame:
    """Rides and share of demand per zone; a zone without rides counts as zero."""
    seen = with_zone(partials, zones).groupBy("pickup_zone").agg(F.sum("ride_count").alias("rides"))
    grid = partials.sparkSession.range(n_zones).select(F.col("id").cast("int").alias("pickup_zone"))
    filled = grid.join(seen, "pickup_zone", "left").select(
        "pickup_zone", F.coalesce("rides", F.lit(0)).alias("rides")
    )
    # One row per zone.
    total = F.sum("rides").over(Window.partitionBy(F.lit(0)))
    return filled.withColumn("share", F.try_divide(F.col("rides"), total))


def share_extremes(shares: DataFrame) -> DataFrame:
    return shares.agg(
        F.min("share").alias("smallest_zone_share"), F.max("share").alias("largest_zone_share")
    )


def concentration(shares: DataFrame, top: int = 10) -> DataFrame:
    """Share of the busiest zone and of the ``top`` busiest together."""
    busiest = shares.orderBy(F.desc("share"), "pickup_zone").limit(top)
    return busiest.agg(
        F.max("share").alias("busiest_share"), exact_sum("share", 1e9).alias("top_share")
    )


def summed_distances(
    points: DataFrame, block_points: int = S.PAIRWISE_BLOCK, point: str = "pickup_location_id"
) -> DataFrame:
    """For every point and cluster, the weighted sum of distances to its members.

    ``points`` holds the point id, ``start_lat, start_lng, pickup_zone, weight``.  Members are
    packed into blocks of bounded size, and points are dealt into tiles.  A task holds the sums
    of one tile while all blocks pass by it, so no pair is ever a row of its own, a block is
    sent once a tile, and a sum leaves the task once.
    """
    count = points.count()
    blocks, tiles = max(1, ceil(count / block_points)), max(1, ceil(count / _TILE))
    block = F.pmod(F.hash(point), F.lit(blocks)).alias("block")
    weight = F.col("weight").cast("double").alias("weight")
    members = (
        points.groupBy(block, F.col("pickup_zone").alias("cluster"))
        .agg(F.collect_list(F.struct("start_lat", "start_lng", weight)).alias("members"))
        .select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), "cluster", "members")
    )
    dealt = F.pmod(F.xxhash64(point, "start_lat", "start_lng", "weight"), F.lit(tiles)).cast("int")
    spots = points.select(dealt.alias("tile"), point, "pickup_zone", "weight", "start_lat", "start_lng")
    sent = spots.unionByName(members, allowMissingColumns=True)
    # A tile is little data but much work, so tiles have tasks of their own.
    sent = sent.repartitionById(tiles, "tile").sortWithinPartitions(F.col("members").isNotNull())
    zone = points.schema["pickup_zone"].dataType
    schema = spots.select(point, "pickup_zone", "weight").schema.add("cluster", zone).add("steps", "decimal(38,0)")
    return (
        sent.mapInArrow(_tile_sums(point), schema)
        .groupBy(point, "pickup_zone", "weight", "cluster")
        .agg((F.sum("steps").cast("double") / F.lit(_DISTANCE_STEPS)).alias("distance"))
    )


def _tile_sums(point: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums, in whole steps, of a task's points (which come first) over the blocks that follow;
    a block in which a distance is missing or not finite adds nothing to a sum."""
    per_unit, wide, exact = _DISTANCE_STEPS, _WIDE, float(1 << 53)

    def steps(x, y, lat, lng, weight):
        """A row of whole steps for each member, in runs that stay in a core's cache."""
        run = max(1, wide // max(1, len(x)))
        for i in range(0, len(lat), run):
            away, up = lat[i : i + run, None] - x, lng[i : i + run, None] - y
            away *= away
            up *= up
            away += up
            np.sqrt(away, out=away)
            away *= weight[i : i + run, None]
            away *= per_unit
            yield np.rint(away, out=away)

    def block_sums(*places):
        """The sums, as whole numbers of any size, and where they are known."""
        total = np.zeros(len(places[0]))
        with np.errstate(all="ignore"):
            for rows in steps(*places):
                total += rows.sum(axis=0)
            known = np.isfinite(total)
            total[~known] = 0
            if total.max(initial=0) < exact and not (places[-1] < 0).any():
                return total.astype(np.int64), known
            whole = np.zeros(len(total), object)
            for rows in steps(*places):
                rows[:, ~known] = 0
                whole += [sum(map(int, column)) for column in rows.T]
        return whole, known

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, x, sums = [], None, {}
        for batch in batches:
            first = batch.column("members").null_count  # points before the first block
            if first:
                own.append(batch.slice(0, first))
            if first == batch.num_rows or not own:
                continue
            if x is None:
                held = pa.Table.from_batches(own).combine_chunks()
                x, y = (held.column(c).to_numpy() for c in ("start_lat", "start_lng"))
            rows = batch.slice(first)
            lists, clusters = rows.column("members"), rows.column("cluster").to_pylist()
            ends, fields = lists.offsets.to_numpy(), lists.values.flatten()
            places = [f.to_numpy(zero_copy_only=False).astype(float) for f in fields]
            for cluster, begin, end in zip(clusters, ends[:-1], ends[1:], strict=True):
                total, known = block_sums(x, y, *(p[begin:end] for p in places))
                high = max(map(abs, (int(total.max()), int(total.min()))))
                whole, seen, top = sums.get(cluster, (np.zeros(len(x), np.int64), np.zeros(len(x), bool), 0))
                if top + high >= 1 << 62:
                    whole, total = whole.astype(object), total.astype(object)
                sums[cluster] = whole + total, seen | known, top + high
        for cluster, (whole, seen, _) in sums.items():
            if whole.dtype == object:
                steps_ = pa.array([Decimal(int(n)) if s else None for n, s in zip(whole, seen, strict=True)], pa.decimal128(38))
            else:
                steps_ = pa.array(whole, mask=~seen).cast(pa.decimal128(38))
            columns = [held.column(c).combine_chunks() for c in (point, "pickup_zone", "weight")]
            columns += [pa.array([cluster] * len(seen), held.schema.field("pickup_zone").type), steps_]
            yield pa.RecordBatch.from_arrays(columns, names=[point, "pickup_zone", "weight", "cluster", "steps"])

    return work


def weighted_silhouette(
    points: DataFrame, block_points: int = S.PAIRWISE_BLOCK, point: str = "pickup_location_id"
) -> DataFrame:
    """Mean Euclidean silhouette as if each point were repeated ``weight`` times.

    Own-cluster distances divide by one less than the cluster's weight, a cluster of a
    single pickup scores zero, and so does a point at distance zero from everything.
    """
    cluster_weights = points.groupBy(F.col("pickup_zone").alias("cluster")).agg(
        F.sum("weight").cast("double").alias("cluster_weight")
    )
    joined = summed_distances(points, block_points, point).join(cluster_weights, "cluster")
    own = F.col("cluster") == F.col("pickup_zone")
    others = F.when(~own, F.col("distance") / F.col("cluster_weight"))
    per_point = joined.groupBy(point, "weight").agg(
        F.max(F.when(own, F.col("distance") / F.greatest(F.col("cluster_weight") - 1, F.lit(1.0)))).alias(
            "within"
        ),
        F.max(F.when(own, F.col("cluster_weight"))).alias("own_weight"),
        F.min(others).alias("nearest"),
    )
    scale = F.greatest("within", "nearest")
    score = F.when((F.col("own_weight") > 1) & (scale > 0), (F.col("nearest") - F.col("within")) / scale)
    scored = per_point.withColumn("score", F.coalesce(score, F.lit(0.0)))
    return scored.agg(
        F.try_divide(
            exact_sum(F.col("score") * F.col("weight"), 1e9, wide=True), F.sum("weight").cast("double")
        ).alias("silhouette")
    )
