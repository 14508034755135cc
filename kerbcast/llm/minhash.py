"""Near-duplicate documents by MinHash with tensored banding.

A document is its set of distinct five-word shingles.  Two collections of ``GROUPS`` groups
of ``DEPTH`` minhashes are computed; every pair (i, j) of a group of the first and one of
the second keys a table of its own, so 2 x GROUPS x DEPTH minhashes serve GROUPS squared
tables with keys of 2 x DEPTH.  At the limit (similarity 0.85) a link is missed with a chance
of about two in ten thousand, and far less above.

Documents with equal sets are one node.  Only nodes that share a group in both collections
with some other node get table keys.  A bucket's nodes are each compared, on full sets, with
one hub: the node whose groups are shared most.  That costs as many comparisons as the
bucket has nodes, and joins a large family of copies around its original.  Where a bucket
still holds several components, its nodes go to an exact search: nodes of different
components that share a shingle among the rarest that a link must share, and whose sizes and
own shingles leave room for one, are compared on full sets.  So no bucket is capped, nor are
all its pairs formed, and no candidate goes unchecked.

Results for odd rows: a text that is null, empty or blank has an empty set, links with
nothing and is its own component; a text of fewer than five words is one shingle; rows with
equal sets share a component, whatever their ids, null ids included; a component is named by
its smallest id; an empty table gives an empty table.  Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbcast.llm.bytetext import IS_WORD, LOWER, SMALL_SLICE, flat, mixed, random_words, run_hashes, runs, slices
from kerbcast.llm.common import components, saved, ship

WORDS = 5
#: Links have PERCENT * union <= 100 * intersection.
PERCENT = 85
GROUPS, DEPTH = 10, 3
_SHINGLE = random_words(41, WORDS + 1)
_HASHES = 2 * GROUPS * DEPTH
_SALT, _FACTOR = random_words(43, _HASHES), random_words(47, _HASHES)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingles of all texts, and each text's first place among them."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, of = runs(IS_WORD[data], offsets)
    hashes = run_hashes(data, starts, ends)
    n = len(texts)
    words = np.bincount(of, minlength=n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(words) - words, words)
    # Every word begins a shingle that ends WORDS - 1 words later, if the text goes on so
    # long; a text of fewer words has one, of all its words.
    full = np.flatnonzero(place + WORDS <= words[of])
    values = np.zeros(len(of), np.uint64)
    values[full] = sum(hashes[full + k] * _SHINGLE[k] for k in range(WORDS))
    short = (words > 0) & (words < WORDS)
    if short.any():
        own = np.flatnonzero(short[of])
        np.add.at(values, (np.cumsum(words) - words)[of[own]], hashes[own] * _SHINGLE[place[own]])
    begins = np.flatnonzero((place + WORDS <= words[of]) | (short[of] & (place == 0)))
    values = mixed(values[begins] + _SHINGLE[WORDS] * np.minimum(words[of[begins]], WORDS).astype(np.uint64))
    return values, np.concatenate(([0], np.cumsum(np.bincount(of[begins], minlength=n))))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def node_of(values: np.ndarray) -> bytes:
    """The name of a set: a digest of its sorted shingles."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _minhashes(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Groups of minhashes by text, two collections side by side; texts have shingles."""
    out = np.zeros((2 * GROUPS, len(firsts)), np.uint64)
    for k in range(_HASHES):
        least = np.minimum.reduceat((values ^ _SALT[k]) * _FACTOR[k], firsts)
        out[k // DEPTH] = mixed(out[k // DEPTH] * np.uint64(0x9E3779B97F4A7C15) + least)
    return out


_SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType(), False),
        T.StructField("node", T.BinaryType()),
        T.StructField("groups", T.ArrayType(T.LongType(), False)),
    ]
)


def signatures(documents: DataFrame, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry``, n_shingles, node (null for an empty set) and groups of minhashes."""
    ship(documents.sparkSession)
    kept = ["doc_id", *carry]
    schema = T.StructType([*[documents.schema[c] for c in kept], *_SIGNED])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", SMALL_SLICE):
                values, at = shingles(part.column("__text"))
                bounds = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
                sets = [distinct(values[b:e]) for b, e in bounds]
                full = np.flatnonzero(np.diff(at))
                groups: list = [None] * len(sets)
                if len(full):
                    for k, g in zip(full.tolist(), _minhashes(values, at[full]).T.view(np.int64), strict=True):
                        groups[k] = g
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in kept],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(groups, pa.list_(pa.int64())),
                    ],
                    names=[*kept, *_SIGNED.names],
                )

    return documents.select(*kept, documents[text].alias("__text")).mapInArrow(work, schema)


def _sets(documents: DataFrame, text: str) -> DataFrame:
    """node and set of every document."""
    schema = "node binary, set array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", SMALL_SLICE):
                values, at = shingles(part.column("__text"))
                sets = [distinct(values[b:e]) for b, e in zip(at[:-1], at[1:], strict=True) if e > b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node_of(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["node", "set"],
                )

    return documents.select(documents[text].alias("__text")).mapInArrow(work, schema)


def _table_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, weight): a key for each table in which the node may meet another; weight
    tells how often its groups are shared."""
    grouped = nodes.select("node", F.posexplode("groups").alias("g", "value"))
    shared = grouped.groupBy("g", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    meeting = (
        grouped.hint("merge").join(shared, ["g", "value"])
        .groupBy("node")
        .agg(
            F.collect_list(F.when(F.col("g") < GROUPS, F.struct("g", "value"))).alias("a"),
            F.collect_list(F.when(F.col("g") >= GROUPS, F.struct("g", "value"))).alias("b"),
            F.sum("n").alias("weight"),
        )
    )
    return (
        meeting.select("node", "weight", "b", F.explode("a").alias("x"))
        .select("node", "weight", "x", F.explode("b").alias("y"))
        .select(F.xxhash64("x.g", "x.value", "y.g", "y.value").alias("key"), "node", "weight")
    )


def _room(x: str, y: str, percent: int) -> Column:
    """Whether sizes allow a link: at least ``percent`` of the larger is in the smaller."""
    return (F.least(x, y) * 100) >= (F.greatest(x, y) * percent)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("x"), F.col("set").alias("x_set"))
    right = sets.select(F.col("node").alias("y"), F.col("set").alias("y_set"))
    both = F.size(F.array_intersect("x_set", "y_set")).cast("long")
    union = F.size("x_set") + F.size("y_set") - F.col("both")
    return (
        pairs.select("x", "y")
        .join(left, "x")
        .join(right, "y")
        .select("x", "y", "x_set", "y_set", both.alias("both"))
        .where(F.col("both") * 100 >= union * percent)
        .select("x", "y")
    )


def linked_components(
    documents: DataFrame, text: str = "text", percent: int = PERCENT, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, ``carry``, n_shingles, component_id, kept and component (the name of a set of
    the component, null for an empty set) of every document."""
    signed = saved(signatures(documents, text, carry), "signed")
    nodes = saved(
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.max("n_shingles").alias("n"),
            F.any_value("groups").alias("groups"),
        ),
        "nodes",
    )
    keys = saved(_table_keys(nodes), "keys")
    hub = F.max(F.struct("weight", "node"))["node"]
    buckets = keys.groupBy("key").agg(hub.alias("hub"), F.count(F.lit(1)).alias("held")).where("held > 1")
    met = saved(keys.select("key", "node").join(buckets.select("key", "hub"), "key"), "met")
    small = nodes.select("node", "n")
    stars = met.where("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y")).distinct()
    sized = stars.join(small.select(F.col("node").alias("x"), F.col("n").alias("nx")), "x").join(
        small.select(F.col("node").alias("y"), F.col("n").alias("ny")), "y"
    )
    stars = sized.where(_room("nx", "ny", percent)).select("x", "y")

    # Full sets of all nodes that met another, from the text of one document each.
    chosen = met.select("node").distinct().join(nodes.select("node", F.col("doc_id").alias("__id")), "node")
    holders = chosen.select("__id").distinct()
    texts = documents.select(F.col("doc_id").alias("__doc"), F.col(text).alias("__body")).join(
        holders, F.col("__doc").eqNullSafe(F.col("__id")), "left_semi"
    )
    sets = _sets(texts, "__body").join(chosen.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = saved(sets, "sets")
    links = saved(_linked(stars, sets, percent), "links")
    first = saved(components(links), "first")

    more = _exact(met, first, sets, percent)
    joined = saved(links.unionByName(more), "joined")
    final = components(joined)
    named = nodes.select("node", "doc_id").join(final, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    named = saved(named, "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = named.join(least, "component").select(F.col("node").alias("__node"), "component", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.join(answer, signed["node"] == answer["__node"], "left").select(
        "doc_id",
        *carry,
        "n_shingles",
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
        "component",
    )


def deduplicated(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id; a document with an
    empty set stays, once for each id and text."""
    keyed = documents.withColumn("__key", F.coalesce(F.xxhash64("text"), F.lit(0)))
    found = linked_components(keyed, percent=percent, carry=("__key",))
    grouped = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key")).alias("first")
    )
    stay = grouped.select("first.doc_id", "first.__key").unionByName(
        found.where("component IS NULL").select("doc_id", "__key").distinct()
    )
    stay = saved(stay.select(F.col("doc_id").alias("__id"), F.col("__key").alias("__stays")), "stay")
    rows = keyed.join(
        stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__stays")), "left_semi"
    )
    return rows.dropDuplicates(["doc_id", "__key"]).select(*documents.columns)


def _exact(met: DataFrame, first: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket."""
    placed = met.select("key", "node").join(first, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("key")
    )
    open_ = placed.join(mixed_keys, "key", "left_semi").select("node", "component").distinct()
    held = saved(open_.join(sets, "node"), "open")
    tokens = held.select("node", "component", F.size("set").cast("long").alias("n"), F.explode("set").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # A link must share one of each side's rarest shingles: of those beyond what it may lack.
    ranked = (
        tokens.hint("merge").join(counts.where("df > 1"), "token")
        .groupBy("node")
        .agg(
            F.any_value("component").alias("component"),
            F.any_value("n").alias("n"),
            F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"),
        )
        .withColumn("own", F.col("n") - F.size("shared"))  # shingles no other open node has
    )
    needed = F.ceil(F.col("n") * percent / 100)
    rare = F.greatest(F.col("n") - needed + 1 - F.col("own"), F.lit(0)).cast("int")
    probes = ranked.select(
        "node", "component", "n", "own", F.size("shared").alias("m"),
        F.posexplode(F.slice("shared", F.lit(1), rare)).alias("at", "t"),
    ).select("node", "component", "n", "m", F.col("t.token").alias("token"), (F.col("n") - F.col("own") - F.col("at")).alias("left"))
    x = probes.select(*[F.col(c).alias(f"x_{c}" if c != "token" else c) for c in probes.columns])
    y = probes.select(*[F.col(c).alias(f"y_{c}" if c != "token" else c) for c in probes.columns])
    # The largest intersection possible, by what others have and by what comes from the
    # shingle on: the first that two sets have in common leaves room for all they share.
    most = F.least("x_m", "y_m", "x_left", "y_left")
    pairs = (
        x.hint("merge").join(y, "token")
        .where(
            (F.col("x_node") < F.col("y_node"))
            & (F.col("x_component") != F.col("y_component"))
            & _room("x_n", "y_n", percent)
            & (most * (100 + percent) >= (F.col("x_n") + F.col("y_n")) * percent)
        )
        .select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))
        .distinct()
    )
    return _linked(pairs, held.select("node", "set"), percent)
