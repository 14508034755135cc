"""Location-hour partials kept up to date as trips arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbcast.functions.exact import MICRO, MICROS_PER_MINUTE, exact_sum_or_zero
from kerbcast.operators.partials import PARTIAL_KEYS, PARTIAL_MEASURES

UPDATE_SCHEMA = (
    "pickup_location_id int, date date, hour int, ride_count bigint, duration_sum double, "
    "duration_n bigint, distance_sum double, distance_n bigint, batch bigint"
)


def hourly_partials(trips: DataFrame, lateness: str | None = None) -> DataFrame:
    """Partials of a stream of measured trips, per location and hour.

    Event time needs a TIMESTAMP, so the wall clock is read as UTC; the session time zone
    must be UTC.  Every row counts, however late: the state is one row per location and
    hour.  With a ``lateness``, an hour's state is dropped once the stream is that far past
    it, and so are rows that come later.
    """
    timed = trips.withColumn("_at", F.col("start_time").cast("timestamp"))
    if lateness is not None:
        timed = timed.withWatermark("_at", lateness)
    grouped = timed.groupBy(
        F.window("_at", "1 hour").alias("_hour"), "pickup_location_id"
    )
    sums = grouped.agg(
        F.count("*").alias("ride_count"),
        exact_sum_or_zero("ride_duration_min", MICROS_PER_MINUTE).alias("duration_sum"),
        F.count("ride_duration_min").alias("duration_n"),
        exact_sum_or_zero("ride_distance_km", MICRO).alias("distance_sum"),
        F.count("ride_distance_km").alias("distance_n"),
    )
    start = F.col("_hour.start")
    return sums.select(
        "pickup_location_id",
        start.cast("date").alias("date"),
        F.hour(start).alias("hour"),
        *PARTIAL_MEASURES,
    )


class UpdateLog:
    """Changed rows under ``out``, one folder a batch, and snapshots that fold the older ones.

    A snapshot holds the latest state of every key up to a batch, which its folder names; it
    and a batch count from the moment their success marker stands, so nobody reads half of
    one.  What a snapshot replaces stays until the next one is there, so a reader that has
    listed the folders finds them all.  A reader opens one snapshot and the batches after it,
    however long the stream has run.
    """

    def __init__(self, spark: SparkSession, out: str) -> None:
        self.spark, self.out = spark, out
        # The engine passes over folders with a leading underscore.
        self.snapshots = f"{out}/_snapshots"

    def _finished(self, folder: str, name: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        marks = path(f"{folder}/{name}=*/_SUCCESS")
        found = marks.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(marks)
        return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found or [])

    def _drop(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Add a batch; one that comes again replaces itself, or is in a snapshot already."""
        if all(batch_id > upto for upto in self._finished(self.snapshots, "upto")):
            batch.write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")

    def folders(self) -> list[str]:
        """What a reader opens: the newest snapshot, if there is one, and the batches after it."""
        snapshots = self._finished(self.snapshots, "upto")
        upto = snapshots[-1] if snapshots else -1
        later = [f"{self.out}/batch={b}" for b in self._finished(self.out, "batch") if b > upto]
        return [f"{self.snapshots}/upto={b}" for b in snapshots[-1:]] + later

    def updates(self) -> DataFrame:
        """The rows of all ``folders``, with the batch that each is of."""
        folders = self.folders()
        reader = self.spark.read.schema(UPDATE_SCHEMA)
        batches = [f for f in folders if not f.startswith(self.snapshots)]
        found = reader.option("basePath", self.out).parquet(*batches) if batches else None
        if len(batches) < len(folders):
            snapshot = self.spark.read.schema(UPDATE_SCHEMA).parquet(folders[0])
            return snapshot if found is None else snapshot.unionByName(found)
        return self.spark.createDataFrame([], UPDATE_SCHEMA) if found is None else found

    def state(self) -> DataFrame:
        """The latest row of every location and hour, and the batch it is of."""
        latest = F.max_by(F.struct(*PARTIAL_MEASURES, "batch"), "batch").alias("_row")
        return self.updates().groupBy(*PARTIAL_KEYS).agg(latest).select(*PARTIAL_KEYS, "_row.*")

    def fold(self) -> None:
        """Fold all batches so far into a new snapshot, then drop what the one before replaced."""
        batches, snapshots = self._finished(self.out, "batch"), self._finished(self.snapshots, "upto")
        if not batches or (snapshots and batches[-1] <= snapshots[-1]):
            return
        self.state().write.mode("overwrite").parquet(f"{self.snapshots}/upto={batches[-1]}")
        for upto in snapshots[:-1]:
            self._drop(f"{self.snapshots}/upto={upto}")
        for batch in batches:
            if snapshots and batch <= snapshots[-1]:
                self._drop(f"{self.out}/batch={batch}")


def run_hourly_partials(
    trips: DataFrame, out: str, checkpoint: str, lateness: str | None = None, fold_every: int = 16
) -> StreamingQuery:
    """Append every changed row to the log at ``out`` and stop at the end.

    A replayed batch replaces its own folder, so updates are written exactly once.  Every
    ``fold_every`` batches the log is folded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = UpdateLog(batch.sparkSession, out)
        log.append(batch, batch_id)
        if (batch_id + 1) % fold_every == 0:
            log.fold()

    return (
        hourly_partials(trips, lateness)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def current_partials(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of every location and hour from the update log."""
    return UpdateLog(spark, out).state().drop("batch")
