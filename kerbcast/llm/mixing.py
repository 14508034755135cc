"""Mixing sources to target weights, with DataFrame operations only.

The words of a source stand end to end in one row of numbers and are packed into blocks of
fixed length.  A source gets as many slots as its target asks for; its slots fall on the
output shards at random, so that the counts of a source over the shards are one multinomial
draw with the source's total fixed.  Slot k of a source takes the block that a pseudorandom
permutation of the source's block numbers gives for k, a new permutation each time round, so
no block is used once more before all were used.  Blocks and slots meet by block number.
All draws are hashes of the seed, so that reruns agree.

A source's words get their places in two steps, within hash buckets and over the buckets'
sums; no task ever orders a whole source.  A bucket holds a 1024th of a source, more only
where one document id is repeated that often.

Results for odd rows: a null text has no words and none are taken; a null source is a source
of its own, ordered last; null ids are allowed; a repeated row counts as often as it stands;
without any words all targets are 0; an empty table gives an empty table.  Extra columns of
any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbcast.llm.common import WORD, saved

#: Words of a block; weights of the sources in their order, repeating.
BLOCK, WEIGHTS, MOST = 64, (5.0, 2.0, 1.0), 3
BUCKETS, SHARDS, SLOT_RUN = 1024, 64, 8192


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, sid, source_size, target): the sources share all words by weight; none gets
    more than MOST times its own, and what is over goes to the others by weight."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    shares = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn("weight", F.element_at(shares, F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1)).withColumn(
        "cap", F.col("source_size") * float(MOST)
    )
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select("source", "sid", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))
    )


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sized`` with its source's columns and ``place``, the number of the document's first
    word within its source."""
    rows = sized.withColumnRenamed("source", "__source").join(
        sources, F.col("__source").eqNullSafe(F.col("source")), "left"
    ).drop("__source")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(BUCKETS)))
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("held"))
    upto = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("first"))
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        rows.withColumn("place", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(sums, ["sid", "bucket"])
        .withColumn("place", F.col("place") + F.col("first"))
        .drop("bucket", "first")
    )


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """The place of ``index`` in a pseudorandom permutation of 0..size-1: rounds that either
    swap an index with its partner of the round or leave both."""

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        swap = F.pmod(F.xxhash64(*key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    rounds = F.array(*[F.lit(r) for r in range(16)])
    return F.aggregate(rounds, index.cast("long"), step)


def slots(sources: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """(shard, sid, slot, epoch, block): which block each slot of the mix takes."""
    # A fixed number, for the runs are few and short before they become slots.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    wanted = F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long")
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("wanted") - 1) / SLOT_RUN))).alias("run")
    runs = (
        sources.where("source_size > 0")
        .withColumn("blocks", blocks)
        .withColumn("wanted", F.least(wanted, F.lit(MOST) * F.col("blocks")))
        .where("wanted > 0")
        .select("sid", "blocks", "wanted", run)
        .repartition(tasks, "sid", "run")
    )
    last = F.least((F.col("run") + 1) * SLOT_RUN, "wanted") - 1
    every = runs.select("sid", "blocks", F.explode(F.sequence(F.col("run") * SLOT_RUN, last)).alias("slot"))
    epoch = F.floor(F.col("slot") / F.col("blocks"))
    key = (F.lit(seed), F.col("sid"), F.col("epoch"))
    return every.withColumn("epoch", epoch).select(
        F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "sid", "slot"), F.lit(shards)).alias("shard"),
        "sid",
        "slot",
        "epoch",
        permuted(F.pmod("slot", "blocks"), F.col("blocks"), *key).alias("block"),
    )


def meeting(parts_rows: DataFrame, drawn: DataFrame) -> DataFrame:
    """Parts beside the slots or draws of their block.  Both grow with the corpus, though the
    slots spring from a table of a few sources, so neither may be broadcast."""
    return parts_rows.hint("merge").join(drawn, ["sid", "block"])


def parts(placed_rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(sid, block, place, start, words): the words of each document in each block; start
    counts from the document's first word."""
    end = F.col("place") + F.col("size")
    first = F.col("block") * block
    start = F.greatest(first, "place")
    return (
        placed_rows.where("size > 0")
        .select(
            "sid", "place", "size",
            F.explode(F.sequence(F.floor(F.col("place") / block), F.floor((end - 1) / block))).alias("block"),
        )
        .select(
            "sid", "block", "place",
            (start - F.col("place")).alias("start"),
            (F.least(first + block, end) - start).alias("words"),
        )
    )


def sized_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "source", word_count().alias("size"))


def mixed(documents: DataFrame, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target and taken: the words the mix takes of each
    document, repeats counted."""
    sized = saved(sized_documents(documents), "sizes")
    sources = saved(source_targets(sized), "sources")
    rows = saved(placed(sized, sources), "placed")
    draws = slots(sources, block, seed=seed).groupBy("sid", "block").agg(F.count(F.lit(1)).alias("draws"))
    taken = (
        meeting(parts(rows, block), draws)
        .groupBy("sid", "place")
        .agg(F.sum(F.col("words") * F.col("draws")).alias("taken"))
        .withColumn("full", F.lit(True))
    )
    joined = rows.withColumn("full", F.col("size") > 0).join(taken, ["sid", "place", "full"], "left")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_texts(documents: DataFrame, block: int = BLOCK, seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of ``documents``: for each time round, a row with
    the words that the mix takes of a document in their order, whole texts unchanged.  Words
    keep the blanks before them; n_chars is the new length.

    A document has at most MOST rows.  Rows equal in id, size and text are told apart by
    number, so each is drawn on its own.
    """
    key = ["__id", "__size", "__text"]
    own = documents.withColumns(
        {"__id": F.col("doc_id"), "__size": word_count(), "__text": F.coalesce(F.xxhash64("text"), F.lit(0))}
    )
    sized = saved(own.select("doc_id", "source", F.col("__size").alias("size"), "__text"), "sizes")
    sources = saved(source_targets(sized), "sources")
    rows = saved(placed(sized, sources), "placed")
    drawn = slots(sources, block, seed=seed).select("sid", "block", "epoch")
    kept = (
        meeting(parts(rows, block), drawn)
        .groupBy("sid", "place", "epoch")
        .agg(F.array_sort(F.collect_list(F.struct("start", "words"))).alias("spans"), F.sum("words").alias("taken"))
    )
    numbered = F.row_number().over(Window.partitionBy("doc_id", "size", "__text").orderBy("place"))
    chosen = (
        rows.where("size > 0")
        .select("sid", "place", "doc_id", "size", "__text", numbered.alias("copy"))
        .join(kept, ["sid", "place"])
        .groupBy(F.col("doc_id").alias("__id"), F.col("size").alias("__size"), "__text")
        .agg(F.collect_list(F.struct("copy", "epoch", "spans", "taken")).alias("__draws"))
    )
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("__text")).alias("__copy")
    found = own.select("*", copy).alias("d").join(
        chosen.alias("c"), [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]
    )
    draws = found.select(
        "d.*", F.explode(F.filter("__draws", lambda x: x["copy"] == F.col("__copy"))).alias("__draw")
    )
    words = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.array_join(
        F.flatten(
            F.transform("__draw.spans", lambda p: F.slice(F.col("__words"), (p["start"] + 1).cast("int"), p["words"].cast("int")))
        ),
        "",
    )
    text = F.when(F.col("__draw.taken") == F.col("__size"), F.col("text")).otherwise(cut)
    out = draws.withColumn("__words", F.when(F.col("__draw.taken") < F.col("__size"), words)).withColumn("text", text)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)
