"""Saving, loading and fingerprinting trained bundles."""

from __future__ import annotations

import json

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.plans.forecast import Bundle, FittedMean, FittedTrees, Zoning

METADATA_SCHEMA = "kind string, centres string, metadata string"


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    """Tables as Parquet, trees through the ML writer, and the metadata row last, so a
    folder without metadata is an unfinished save."""
    zoning = bundle.zoning
    zoning.zone_map.coalesce(1).write.mode("overwrite").parquet(f"{path}/zone_map")
    zoning.profile.coalesce(1).write.mode("overwrite").parquet(f"{path}/profile")
    if isinstance(bundle.fitted, FittedTrees):
        kind = "trees"
        bundle.fitted.model.write().overwrite().save(f"{path}/trees")
    else:
        kind = "mean"
        bundle.fitted.cells.coalesce(1).write.mode("overwrite").parquet(f"{path}/means")
    row = (kind, json.dumps(zoning.centres), json.dumps(bundle.metadata))
    metadata = spark.createDataFrame([row], METADATA_SCHEMA)
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    row = spark.read.schema(METADATA_SCHEMA).json(f"{path}/metadata").first()
    if row is None:
        raise ValueError(f"{path} holds no finished bundle")
    metadata = json.loads(row["metadata"])
    zoning = Zoning(
        [tuple(centre) for centre in json.loads(row["centres"])],
        spark.read.parquet(f"{path}/zone_map"),
        spark.read.parquet(f"{path}/profile"),
    )
    if row["kind"] == "trees":
        model = GBTRegressionModel.load(f"{path}/trees")
        fitted = FittedTrees(model, tuple(metadata["feature_order"]))
    else:
        fitted = FittedMean(spark.read.parquet(f"{path}/means"))
    return Bundle(zoning, fitted, metadata)


def copy_files(spark: SparkSession, source: str, target: str) -> None:
    """Copy a bundle's files as they are (a handful of small ones)."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    here, there = hadoop.Path(source), hadoop.Path(target)
    done = hadoop.FileUtil.copy(
        here.getFileSystem(conf), here, there.getFileSystem(conf), there, False, conf
    )
    if not done:
        raise OSError(f"{source} could not be copied to {target}")


def bundle_files(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every stored file: ``file, sha256``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.substring_index("path", f"{path.rstrip('/').split('/')[-1]}/", -1)
    return files.select(name.alias("file"), F.sha2("content", 256).alias("sha256"))


def bundle_digest(spark: SparkSession, path: str) -> str:
    """One digest over all stored files of a bundle (a handful of small files)."""
    lines = F.sort_array(F.collect_list(F.concat_ws(" ", "file", "sha256")))
    return bundle_files(spark, path).agg(F.sha2(F.concat_ws("\n", lines), 256)).first()[0]
