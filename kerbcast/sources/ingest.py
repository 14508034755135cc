"""Months: which are there, which to take in, and how a month is published.

New files land in ``landing/month=YYYY-MM``.  A month becomes visible in the curated table
only after its files were read in full and matched the contract; months already curated
are never touched again.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbcast import settings as S
from kerbcast.functions.clock import month_text, parse_month, shift_month, to_month
from kerbcast.operators.periods import calendar

ALREADY_PRESENT, DOWNLOADED, NOT_PUBLISHED = "already_present", "downloaded", "not_published"

CURATED_TYPES = {
    "tpep_pickup_datetime": T.TimestampNTZType(),
    "tpep_dropoff_datetime": T.TimestampNTZType(),
    "PULocationID": T.IntegerType(),
    "DOLocationID": T.IntegerType(),
    "trip_distance": T.DoubleType(),
    "fare_amount": T.DoubleType(),
}
#: Footers of a month's files that are read at a time.
FOOTER_READERS = 16
VIOLATION_SCHEMA = "path string, rule string, column_name string, detail string"


class ContractError(ValueError):
    """A landed month does not meet the trip-file contract."""


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The partitioned table at ``path``, or None if there is none yet."""
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def available_months(spark: SparkSession, path: str) -> DataFrame:
    """The months of a table as ``month DATE``, oldest first; empty without a table.

    Only the partition column is read, so no data page is touched.
    """
    found = read_table(spark, path)
    if found is None:
        return spark.createDataFrame([], "month date")
    months = found.select(F.col("month").cast("string").alias("month")).distinct()
    return months.select(parse_month("month").alias("month")).orderBy("month")


def ingest_status(wanted: DataFrame, present: DataFrame, landed: DataFrame) -> DataFrame:
    """Per wanted month: present already, to be taken in, or not published yet."""
    present = present.select("month", F.lit(True).alias("is_present"))
    landed = landed.select("month", F.lit(True).alias("is_landed"))
    status = (
        F.when(F.col("is_present"), ALREADY_PRESENT)
        .when(F.col("is_landed"), DOWNLOADED)
        .otherwise(NOT_PUBLISHED)
    )
    joined = wanted.join(present, "month", "left").join(landed, "month", "left")
    return joined.select("month", status.alias("status"))


def default_range(today: dt.date) -> tuple[dt.date, dt.date]:
    """The lookback used when no start month is named."""
    last = to_month(today)
    return shift_month(last, -S.INGEST_LOOKBACK_MONTHS), last


def _schema_violations(path: str, schema: T.StructType) -> list[tuple[str, str, str, str]]:
    found = []
    names = set(schema.names)
    missing = sorted(set(S.RAW_COLUMNS) - names)
    found += [(path, "missing_column", name, "") for name in missing]
    for name in sorted(set(S.RAW_COLUMNS) & names):
        kind = schema[name].dataType
        is_time = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
        is_number = isinstance(kind, (T.IntegralType, T.FractionalType)) and not isinstance(
            kind, T.DecimalType
        )
        if is_time != name.endswith("_datetime") or not (is_time or is_number):
            found.append((path, "wrong_type", name, kind.simpleString()))
    return found


def checksum_columns(df: DataFrame) -> list[Column]:
    """Row count and an order-free hash over every column: needs all data decoded.  Hashes
    are added, so that a row that occurs twice counts twice."""
    hashed = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    return [F.count("*").alias("n_rows"), F.sum(hashed.cast("decimal(38,0)")).alias("hash")]


def checksum(df: DataFrame) -> dict:
    return df.agg(*checksum_columns(df)).first().asDict()


#: What the engine says of a file that cannot be read as Parquet; any other failure (access,
#: network, memory) is not the file's.
_UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA", "not a Parquet file")


def _unreadable(path: str, error: Exception) -> list[tuple[str, str, str, str]]:
    """The violation that a failed read shows; an error of another kind is raised again."""
    if not any(sign in str(error) for sign in _UNREADABLE):
        raise error
    return [(path, "unreadable", "", str(error).splitlines()[0])]


def _footer(spark: SparkSession, path: str) -> tuple[str, T.StructType | None, list]:
    try:
        return path, spark.read.parquet(path).schema, []
    except Exception as error:
        return path, None, _unreadable(path, error)


def files_by_schema(
    spark: SparkSession, path: str, readers: int = FOOTER_READERS
) -> tuple[list[DataFrame], list]:
    """The landed files, read together where their schemas are equal, and what is wrong
    with the schema of any of them.  ``readers`` footers are read at a time."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    paths = [row["path"] for row in listed.select("path").orderBy("path").collect()]
    groups: dict[str, list[str]] = {}
    found = []
    with ThreadPoolExecutor(max_workers=readers) as threads:
        read = inheritable_thread_target(spark)(_footer)
        for file, schema, wrong in threads.map(lambda file: read(spark, file), paths):
            found += wrong if schema is None else _schema_violations(file, schema)
            if schema is not None:
                groups.setdefault(schema.json(), []).append(file)
    if not groups and not found:
        found.append((path, "unreadable", "", "there are no files"))
    return [spark.read.parquet(*files) for files in groups.values()], found


def contract_violations(spark: SparkSession, path: str) -> DataFrame:
    """What is wrong with landed files: missing columns, wrong types, unreadable data.

    Each file's schema is checked by itself, and every column is decoded, used or not: a
    file's footer can be intact while its pages are damaged.
    """
    groups, found = files_by_schema(spark, path)
    for group in groups if not found else []:
        try:
            checksum(group)
        except Exception as error:
            found += _unreadable(path, error)
    return spark.createDataFrame(found, VIOLATION_SCHEMA)


def _raise_first(violations: list) -> None:
    for path, rule, column, detail in violations:
        raise ContractError(f"{path}: {rule} {column} {detail}")


def assert_contract(spark: SparkSession, path: str) -> None:
    """Raise if landed files break the contract."""
    _raise_first(contract_violations(spark, path).take(1))


def to_curated(landed: DataFrame, month: dt.date) -> DataFrame:
    """Canonical types for the contract's columns; extra columns stay as they are."""
    extra = [F.col(f"`{name}`") for name in landed.columns if name not in CURATED_TYPES]
    typed = [F.col(name).cast(kind).alias(name) for name, kind in CURATED_TYPES.items()]
    return landed.select(*typed, *extra, F.lit(f"{month:%Y-%m}").alias("month"))


def publish_month(spark: SparkSession, landing: str, curated: str, month: dt.date) -> None:
    """Check, stage, compare, then put one month into the curated table.

    A failure at any step leaves the curated table as it was.  Staging writes every
    column, so it decodes the landed files in full, and their checksum is observed during
    that one read.
    """
    source = f"{landing}/month={month:%Y-%m}"
    staged = f"{curated}_staging/month={month:%Y-%m}"
    groups, found = files_by_schema(spark, source)
    _raise_first(found)
    wanted = to_curated(groups[0], month).drop("month")
    for group in groups[1:]:
        wanted = wanted.unionByName(to_curated(group, month).drop("month"), allowMissingColumns=True)
    observed = Observation()
    try:
        wanted.observe(observed, *checksum_columns(wanted)).write.mode("overwrite").parquet(staged)
    except Exception as error:
        _raise_first(_unreadable(source, error))
    written = spark.read.parquet(staged).select(*wanted.columns)
    if checksum(written) != observed.get:
        raise ContractError(f"{staged} does not read back as written")
    (
        written.withColumn("month", F.lit(f"{month:%Y-%m}"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(curated)
    )
    done = spark._jvm.org.apache.hadoop.fs.Path(staged)
    done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)


@dataclass
class IngestResult:
    downloaded: list[dt.date] = field(default_factory=list)
    already_present: list[dt.date] = field(default_factory=list)
    not_published: list[dt.date] = field(default_factory=list)


def ingest_months(
    spark: SparkSession, landing: str, curated: str, first: str | dt.date, last: str | dt.date
) -> IngestResult:
    """Publish every landed month of the inclusive range that is not curated yet.

    Safe to run again: a month without files is skipped, and one that fails its checks
    raises and stays out, after the months before it were published.
    """
    status = ingest_status(
        calendar(spark, first, last),
        available_months(spark, curated),
        available_months(spark, landing),
    )
    result = IngestResult()
    for row in status.orderBy("month").collect():
        if row["status"] == DOWNLOADED:
            publish_month(spark, landing, curated, row["month"])
        getattr(result, row["status"]).append(row["month"])
    return result


def status_text(status: DataFrame) -> DataFrame:
    return status.select(month_text("month").alias("month"), "status")
