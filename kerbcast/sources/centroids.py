"""The location lookup: one row per location with its centre point."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CENTROID_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.IntegerType()),
        T.StructField("zone", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
    ]
)


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CENTROID_SCHEMA).option("header", True).csv(path)


def centroids_present(spark: SparkSession, path: str) -> bool:
    """Whether a finished lookup is there.

    Output files appear only when the write commits, so a folder left by an interrupted
    write holds no rows and does not count.
    """
    try:
        return bool(read_centroids(spark, path).take(1))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_centroids(centroids: DataFrame, path: str) -> bool:
    """Write the lookup as CSV with a header, unless one is already there."""
    if centroids_present(centroids.sparkSession, path):
        return False
    names = [field.name for field in CENTROID_SCHEMA]
    ordered = centroids.select(*names).orderBy("location_id").coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(path)
    return True
