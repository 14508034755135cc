"""Conversation prefix trie by truncation peeling.

Nodes are the distinct sequences of first turns.  Every conversation enters at its own end,
its greatest depth.  A round groups what stands at equal prefixes: conversations that end
there and nodes that lost their last turn.  A group that all conversations of its prefix have
reached becomes a node; its last turn is stripped, and the turns before it for as long as
nobody else shares the prefix, each giving a node.  What is left waits at the first prefix
that others share, until they have come.  Counts, leaves and savings are added up on the
way, so nodes are found and aggregated in one descent to the root.

There are as many rounds as merges above one another, not as many as turns: a long tail of
one conversation goes in a single step.  Each round's groups are combined before the shuffle,
so a first turn that a third of all conversations share costs a row a task, and are
written to the shared folder.

Texts are replaced by digests of 128 bits before the first shuffle; a prefix's key is a
digest of the prefix before it and its last turn.  Equal conversations are one row with a
count.  A row holds the keys of one conversation's turns (some 60 bytes a turn).

Results for odd rows: null roles and texts count as empty; null turns come first; turns of one
number are ordered by role and then by digest of role and text, so that repeated rows are
turns of their own; rows without a conversation id belong to no conversation and are left
out; an empty table has no nodes, not even a root.  Extra columns of any name are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import saved, ship

ROOT = bytes(16)
#: Ids of equal conversations are gathered in blocks of 2^SHIFT successive ids.
SHIFT = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def gathered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest and bytes of text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, 32))
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    turns = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"], t["bytes"]))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Conversations whose first turns are those of their family's first conversation."""
    own = turns.select(
        "conv_id",
        "turns",
        (F.col("conv_id") - F.col("conv_id") % family).alias("family"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int").alias("h"),
    )
    first = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, heads - 1).alias("head")
    )
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    tail = F.slice(F.col("turns"), F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(first, "family", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of all prefixes, from the root, with bytes of the last text and of all texts."""
    for batch in batches:
        keys, sizes, totals = [], [], []
        for turns in batch.column("turns").to_pylist():
            key, total = ROOT, 0
            own, size, running = [key], [0], [0]
            for t in turns:
                key = hashlib.blake2b(key + t["digest"], digest_size=16).digest()
                total += t["bytes"]
                own.append(key)
                size.append(t["bytes"])
                running.append(total)
            keys.append(own)
            sizes.append(size)
            totals.append(running)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array([own[-1] for own in keys], pa.binary()),
                pa.array(keys, pa.list_(pa.binary())),
                pa.array(sizes, pa.list_(pa.int64())),
                pa.array(totals, pa.list_(pa.int64())),
            ],
            names=["conv_id", "end", "keys", "sizes", "totals"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of the ids of each end; blocks of ids come in order, as a stream."""
    end, state = None, None

    def made(end: bytes, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([end], pa.binary()), pa.array([state.hexdigest()])], names=["end", "ends"]
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["end"] != end:
                if state is not None:
                    yield made(end, state)
                end, state = row["end"], hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(map(str, row["ids"])).encode())
    if state is not None:
        yield made(end, state)


def _distinct(turns: DataFrame) -> DataFrame:
    """A row for each different conversation: its path, its smallest id, how many have it, and
    a digest of their ids."""
    chained = saved(
        turns.mapInArrow(_chained, "conv_id long, end binary, keys array<binary>, sizes array<long>, totals array<long>"),
        "chained",
    )
    blocks = (
        chained.groupBy("end", F.shiftright("conv_id", SHIFT).alias("block"))
        .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .repartition("end")
        .sortWithinPartitions("end", "block")
        .select("end", "ids")
    )
    ends = blocks.mapInArrow(_digests, "end binary, ends string")
    once = chained.groupBy("end").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n"),
        F.first("keys").alias("keys"),
        F.first("sizes").alias("sizes"),
        F.first("totals").alias("totals"),
    )
    return saved(once.join(ends, "end"), "distinct")


def _states(distinct: DataFrame) -> DataFrame:
    """Where the descent begins: each conversation at its end, with its path.

    A path's entries say how many different conversations share the prefix (``m``), which
    tells when all have arrived, and the smallest id among them.
    """
    entries = F.transform(
        "keys", lambda k, i: F.struct(i.alias("depth"), k.alias("key"), F.get("sizes", i).alias("bytes"), F.get("totals", i).alias("total"))
    )
    steps = distinct.select("end", "conv_id", F.explode(entries).alias("e")).select("end", "conv_id", "e.*")
    shared = steps.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("conv_id").alias("first"))
    entry = F.struct("depth", "key", "bytes", "total", "m", "first")
    paths = steps.drop("conv_id").join(shared, "key").groupBy("end").agg(F.array_sort(F.collect_list(entry)).alias("path"))
    zero = F.lit(0).cast("long")
    return distinct.select("end", "conv_id", "n", "ends").join(paths, "end").select(
        "path",
        "conv_id",
        "n",
        F.lit(1).cast("long").alias("q"),
        zero.alias("children"),
        zero.alias("leaves"),
        zero.alias("saved"),
        "ends",
    )


def _met(states: DataFrame) -> DataFrame:
    """Groups of what stands at equal prefixes."""
    last = F.element_at("path", -1)
    sums = [F.sum(name).alias(name) for name in ("n", "q", "children", "leaves", "saved")]
    return states.groupBy(last["key"].alias("key")).agg(
        F.first("path").alias("path"), F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends")
    )


def _stripped(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, states): the nodes of complete groups down to the prefix that others share,
    and what goes on from there, beside the groups that still wait."""
    done = F.col("q") == F.element_at("path", -1)["m"]
    alone = met.where(done).withColumns(
        {
            # Entries before this index are shared by more conversations.
            "top": F.size(F.filter("path", lambda e: e["m"] > F.col("q"))),
            "leaves": F.when(F.col("children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")),
            "all": F.element_at("path", -1)["total"],
        }
    )

    def savings(at: Column) -> Column:
        """Of this entry and all below it."""
        below = F.col("all") - at["total"] + at["bytes"]
        return F.col("saved") + (F.col("n") - 1) * below

    depth = F.col("e.depth")
    bottom = depth == F.size("path") - 1
    nodes = alone.withColumn("e", F.explode(F.expr("slice(path, top + 1, size(path) - top)"))).select(
        "conv_id",
        depth.cast("long").alias("depth"),
        F.when(depth > 0, F.get("path", depth - 1)["first"]).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        savings(F.col("e")).alias("saved_tokens"),
        F.when(bottom, F.coalesce("ends", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    top = F.get("path", F.col("top"))
    going = alone.where("top > 0").select(
        F.expr("slice(path, 1, top)").alias("path"),
        "conv_id",
        "n",
        "q",
        F.lit(1).cast("long").alias("children"),
        "leaves",
        savings(top).alias("saved"),
        F.lit(None).cast("string").alias("ends"),
    )
    return nodes, going.unionByName(met.where(~done).drop("key"))


def peeled(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, turns as ``gathered`` gives them)."""
    ship(turns.sparkSession)
    states = saved(_states(_distinct(turns)), "states")
    found = None
    while True:
        met = saved(_met(states), "met")
        nodes, states = _stripped(met)
        found = nodes if found is None else found.unionByName(nodes)
        # The root is the last to be complete.
        if not met.where(~((F.size("path") == 1) & (F.col("q") == F.element_at("path", -1)["m"]))).take(1):
            return found


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations."""
    return peeled(rebuilt(gathered(conversations)))
