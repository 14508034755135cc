"""Incremental month ingest as a file stream.

The stream's checkpoint remembers which landed files were seen, so every run reads new
files only.  Publishing goes through the same checks as the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kerbcast.functions.clock import parse_month
from kerbcast.sources.ingest import ContractError, available_months, publish_month

NOTE_SCHEMA = "batch_id long, month date, kind string, detail string"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """New files of ``landing/month=YYYY-MM`` as a stream of their months.

    Only the partition column is read here; the checks read the data.
    """
    schema = T.StructType([T.StructField("month", T.StringType())])
    return spark.readStream.schema(schema).option("basePath", landing).parquet(landing)


def ingest_stream(
    spark: SparkSession, landing: str, curated: str, checkpoint: str
) -> StreamingQuery:
    """Publish the months of files not seen before, then stop.

    A month already curated is left alone, so replaying a batch after a crash is safe.  A
    month that breaks the contract does not hold up the others: it is noted in the log at
    ``curated`` + ``_rejected``, as are files that landed after their month was published.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        months = batch.select(parse_month("month").alias("month")).distinct()
        curated_months = available_months(spark, curated).withColumn("known", F.lit(True))
        notes = []
        for row in months.join(curated_months, "month", "left").orderBy("month").collect():
            if row["known"]:
                notes.append((batch_id, row["month"], "late", "the month was already published"))
                continue
            try:
                publish_month(spark, landing, curated, row["month"])
            except ContractError as error:
                notes.append((batch_id, row["month"], "violation", str(error)))
        if notes:
            log = spark.createDataFrame(notes, NOTE_SCHEMA).coalesce(1)
            log.write.mode("overwrite").parquet(f"{curated}_rejected/batch={batch_id}")

    return (
        landed_files(spark, landing)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
    )
