"""A corpus cleaned and encoded in stages, each by one operator of ``kerbcast.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs, the documents that the
stage before kept; its result is written as Parquet and read again as the next one's docs.
Once that has happened nothing reads the scratch tables of the stage before, and they go.
All but the last return the columns of documents.  Null, empty and repeated rows are
treated as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.llm import minhash, mixing, pieces, pii, rules
from kerbcast.llm.common import discard, saved, staged, table


@staged
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return rules.filtered(docs, table(spark, sf_dir, "labels"))


@staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity of 0.8 or more) stays."""
    return minhash.deduplicated(docs, percent=80)


@staged
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redacted(docs)


@staged
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each time a document is drawn from."""
    return mixing.mixed_texts(docs)


@staged
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and their spans in the source bytes."""
    encoded = pieces.encode(
        docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source")
    )
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "begins", "ends"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", encoding),
]
#: Learnt rules, minhash links and the tokenizer are beyond SQL; the stages are tested
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), ()
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.split()[0])
        discard(*read)
        read = (docs,)
    return STAGES[-1][1](spark, docs, sf_dir)
