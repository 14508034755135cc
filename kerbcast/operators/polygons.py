"""Area-weighted centre points of polygons given as vertex rows.

Input: ``id, name, shape, ring, seq, x, y`` with planar coordinates, ``seq`` counting a
ring's vertices without gaps, and each ring closed (last vertex equal to the first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.operators.lookups import lookup_join


def polygon_centroids(vertices: DataFrame) -> DataFrame:
    """One centre point per id; shapes sharing an id are merged.

    Areas are signed, so a hole, which winds the other way, subtracts by itself.
    Coordinates are taken relative to each shape's first vertex to keep precision.
    Edges come from an equi-join of each vertex with the next, keyed down to the vertex,
    so a polygon of any size spreads over all tasks.
    """
    origins = vertices.groupBy("id", "shape").agg(
        F.min_by(F.struct("x", "y"), F.struct("ring", "seq")).alias("origin")
    )
    local = lookup_join(vertices, origins, ["id", "shape"]).select(
        "id",
        "shape",
        "ring",
        "seq",
        "name",
        (F.col("x") - F.col("origin.x")).alias("x"),
        (F.col("y") - F.col("origin.y")).alias("y"),
        "origin",
    )
    following = local.select(
        "id",
        "shape",
        "ring",
        (F.col("seq") - 1).alias("seq"),
        F.col("x").alias("next_x"),
        F.col("y").alias("next_y"),
    )
    cross = F.col("x") * F.col("next_y") - F.col("next_x") * F.col("y")
    edges = local.join(following, ["id", "shape", "ring", "seq"]).withColumn("cross", cross)
    shapes = edges.groupBy("id", "shape").agg(
        (F.sum("cross") / 2).alias("area"),
        (F.sum((F.col("x") + F.col("next_x")) * F.col("cross")) / 6).alias("moment_x"),
        (F.sum((F.col("y") + F.col("next_y")) * F.col("cross")) / 6).alias("moment_y"),
        F.min("name").alias("name"),
        F.min("origin").alias("origin"),
    )
    merged = shapes.groupBy("id").agg(
        F.min_by("name", "shape").alias("name"),
        F.sum("area").alias("area"),
        F.sum(F.col("moment_x") + F.col("area") * F.col("origin.x")).alias("moment_x"),
        F.sum(F.col("moment_y") + F.col("area") * F.col("origin.y")).alias("moment_y"),
    )
    return merged.select(
        "id",
        "name",
        "area",
        F.try_divide("moment_x", "area").alias("x"),
        F.try_divide("moment_y", "area").alias("y"),
    )
