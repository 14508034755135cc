"""Scratch tables in the shared folder, table reads, and connected components."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.session import ensure_checkpoint_dir

#: Words of every contract: runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Of each thread, the scratch tables of the stage that it runs or ran last.
_stage = threading.local()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once an application, so that tasks in Python
    run where only the driver has it installed."""
    context = spark.sparkContext
    if getattr(context, "_kerbcast_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="kerbcast-code-")) / "kerbcast_code.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._kerbcast_shipped = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/kerbcast-llm-{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from the files: nothing upstream is
    computed again, and no executor holds the only copy."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._kerbcast_path = path
    if getattr(_stage, "open", False):
        _stage.tables.append(table)
    return table


def discard(*tables: DataFrame) -> None:
    """Remove saved tables that nothing reads any more: all that came from them must have
    been saved itself."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._kerbcast_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def staged(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage (spark, docs, ...) of a chain in which each result is written before the next
    stage begins.  Beginning a stage removes the scratch tables that the stage before it, in
    the same thread and session, made, but for those that ``docs`` still reads."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, *rest) -> DataFrame:
        before = [t for t in getattr(_stage, "tables", []) if t.sparkSession is docs.sparkSession]
        read = docs.inputFiles() if before else []
        needed = [any(Path(t._kerbcast_path).name in file for file in read) for t in before]
        discard(*[t for t, still in zip(before, needed, strict=True) if not still])
        _stage.tables, _stage.open = [t for t, still in zip(before, needed, strict=True) if still], True
        try:
            return stage(spark, docs, *rest)
        finally:
            _stage.open = False

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (x, y); the component
    is its smallest node.

    Alternating large and small stars: each round points every node at the smallest
    neighbour it knows.  A node with any number of neighbours only costs that many rows;
    minima are combined before the shuffle.  Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    pairs = saved(
        edges.where("x <> y")
        .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
        .distinct(),
        "edges",
    )
    state = _fingerprint(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m")
        )
        large = (
            both.join(least, both["u"] == least["k"])
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = saved(large, "large")
        small_least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = (
            large.join(small_least, large["u"] == small_least["k"])
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        pairs = saved(small, "small")
        before, state = state, _fingerprint(pairs)
        if before == state:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]
