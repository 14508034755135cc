"""Small JSON records: metrics and decisions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast import settings as S

DECISION_SCHEMA = (
    "promoted boolean, reason string, candidate_version int, previous_version int, "
    "candidate_wape double, current_wape double, evaluation_wape double, test_month string"
)
METRICS_SCHEMA = "mae double, rmse double, wape double, n_train_rows bigint, n_test_rows bigint"


def write_records(records: DataFrame, path: str) -> None:
    """Overwrite ``path`` with JSON lines.  For tables of a few rows."""
    records.coalesce(1).write.mode("overwrite").json(path)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The records at ``path``, or None if nothing was written there."""
    try:
        found = spark.read.schema(schema).json(path)
        return found if found.take(1) else None
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def save_metrics(spark: SparkSession, metadata: dict, path: str) -> None:
    """A training run's scores and row counts."""
    numbers = {name: metadata["metrics"].get(name) for name in ("mae", "rmse", "wape")}
    row = (*numbers.values(), metadata["n_train_rows"], metadata["n_test_rows"])
    write_records(spark.createDataFrame([row], METRICS_SCHEMA), path)


def record_decision(spark: SparkSession, decision: dict, path: str) -> bool:
    """Write the decision; returns whether it was written.

    A bare "already current" result never replaces a record: it says nothing about how
    the model came into service.
    """
    if (
        decision["reason"] == S.ALREADY_CURRENT
        and read_records(spark, path, DECISION_SCHEMA) is not None
    ):
        return False
    write_records(spark.createDataFrame([decision], DECISION_SCHEMA), path)
    return True


def encode(columns: list[str]) -> Column:
    """The columns as one JSON object, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def decode(text: str, schema: str) -> Column:
    return F.from_json(text, schema)
