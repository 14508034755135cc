"""Independent Spark jobs side by side, their results in a keyed table.

Fits of different settings share nothing but their input, and one alone leaves most of a
cluster idle between its stages.  A bounded number of threads submits them, each in a scheduler
pool of its own (under ``spark.scheduler.mode=FAIR`` they share the executors evenly).  Every
result is appended under its key as soon as it is there, so a run that was cut short goes on
with the keys that are missing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from kerbcast.session import shared_folder

#: Jobs submitted at a time.
WORKERS = 4


class KeyedResults:
    """Rows appended one at a time under a folder; the first columns are the key."""

    def __init__(self, spark: SparkSession, schema: str, n_keys: int, path: str | None = None) -> None:
        self.spark, self.schema, self.n_keys = spark, schema, n_keys
        self.path = path or shared_folder(spark, "results")
        self._lock = Lock()

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], self.schema)
            raise

    def keys(self) -> set[tuple]:
        """What has been done already: one short key a result."""
        found = self.rows()
        return {tuple(row) for row in found.select(*found.columns[: self.n_keys]).distinct().collect()}

    def append(self, row: Sequence) -> None:
        table = self.spark.createDataFrame([tuple(row)], self.schema)
        # Writers of one folder would clear each other's unfinished files.
        with self._lock:
            table.coalesce(1).write.mode("append").parquet(self.path)


def run_all(
    jobs: Mapping[tuple, Callable[[], Sequence]], results: KeyedResults, workers: int = WORKERS
) -> DataFrame:
    """Run the jobs whose key has no result yet, ``workers`` at a time, and give all results.

    A job returns the columns after its key.  When one fails, those not yet begun are dropped, its
    error is raised, and the results so far stay.
    """
    spark, done = results.spark, results.keys()

    def run(key: tuple, job: Callable[[], Sequence], slot: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"jobs-{slot}")
        results.append([*key, *job()])

    todo = [(key, job) for key, job in jobs.items() if key not in done]
    with ThreadPoolExecutor(max_workers=workers) as threads:
        target = inheritable_thread_target(spark)(run)
        running = [threads.submit(target, key, job, i % workers) for i, (key, job) in enumerate(todo)]
        finished, waiting = wait(running, return_when=FIRST_EXCEPTION)
        for future in waiting:
            future.cancel()
    for future in finished:
        future.result()
    return results.rows()
