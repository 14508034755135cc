"""Token totals by source, language and tokenizer version, kept up by signed changes.

A change is a row with ``docs`` and ``tokens`` to add: an insert adds a document and its
tokens, a delete takes them away, a revised count adds the difference.  A batch of changes
is summed by key before it is shuffled and written as one small delta table; totals are the
sums of the deltas of all committed batches, so no batch reads what earlier ones wrote.

A batch is committed by an empty marker file that names the batch and its data folder,
created after the data are complete.  A batch that has a marker is not written again; if two
attempts race, readers take the first marker by name and ignore the other's data.  So a
batch counts once however often it is sent, and one that broke off counts not at all.

Results for odd rows: null sources, languages and versions are keys of their own; null
tokens count as none; repeated rows in a batch are changes each; an empty batch is
committed and changes nothing; keys without documents and tokens are left out.  Extra
columns are left alone.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, docs long, tokens long"


def _changes(counts: DataFrame, docs: int, tokens: Column) -> DataFrame:
    return counts.select(*KEYS, F.lit(docs).cast("long").alias("docs"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that add documents; counts has the keys and tokens."""
    return _changes(counts, 1, F.col("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take documents away, with the tokens they were counted with."""
    return _changes(counts, -1, -F.col("tokens"))


def revisions(counts: DataFrame) -> DataFrame:
    """Changes of documents' tokens from ``tokens`` to ``revised``."""
    return _changes(counts, 0, F.coalesce("revised", F.lit(0)) - F.coalesce("tokens", F.lit(0)))


class TokenRollup:
    """Deltas and markers in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _committed(self) -> dict[str, str]:
        """Batch -> its data folder."""
        markers = self._files().globStatus(self._path("commits", "*"))
        names = sorted(m.getPath().getName() for m in markers or [])
        found: dict[str, str] = {}
        for name in names:
            batch, _, folder = name.rpartition("~")
            found.setdefault(unquote(batch), folder)
        return found

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was there already."""
        if batch in self._committed():
            return False
        folder = uuid.uuid4().hex
        summed = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        summed.where("docs <> 0 OR tokens <> 0").write.parquet(f"{self.root}/deltas/{folder}")
        self._files().create(self._path("commits", f"{quote(batch, safe='')}~{folder}"), False).close()
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs and n_tokens over all committed batches."""
        folders = [f"{self.root}/deltas/{folder}" for folder in self._committed().values()]
        if folders:
            deltas = self.spark.read.schema(SCHEMA).parquet(*folders)
        else:
            deltas = self.spark.createDataFrame([], SCHEMA)
        return (
            deltas.groupBy(*KEYS)
            .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
            .where("n_docs <> 0 OR n_tokens <> 0")
        )
