"""Near-duplicate vectors by iterative quantisation, within equal labels.

A rotation is learnt that makes the signs of the centred, projected vectors balanced binary
codes (alternating between codes and the rotation that fits them best), on a sample bounded by
``SAMPLE`` vectors; rotations from different starts give 64 bits each.  Disjoint parts of the
bits are the keys of Hamming tables.  Every vector is in each table, and looks up its own part
and all parts one bit away.

How many bits two vectors at the limit differ in depends on the data: the more the vectors have
in common, the wider the centred angle of a given cosine.  So it is measured (``shares``):
sampled vectors are turned by the limit's angle, at random and towards other sampled vectors.
There are as many tables as it takes for these pairs to miss each other in all of them with a
chance of ``MISS`` at most, and parts are as long as makes lookups and expected meetings fewest
for the largest label (``plan``).  Where the limit's angle says nothing of the bits, parts get
so short that all vectors of a label meet.  Pairs that meet are compared by the bits of the
first ``CODES`` rotations, by a limit from the same measure, then by the cosine of their
vectors in double precision.

Equal vectors of a label are one node with a count, so copies are never paired.

Results for odd rows: a vector that is null, empty or zero, or holds a null, NaN or infinite
component, or has no label, links with nothing and is its own component; vectors of unequal
length are not compared; repeated rows count as vectors of their own, linked with each
other; null ids are allowed; an empty table gives an empty table.  Extra columns are left
alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import components, saved, ship

COSINE = 0.93
#: Vectors that the rotations are learnt from, at most about.
SAMPLE = 4096
#: Codes that pairs are compared by, that shares of bits are measured on, most codes that parts
#: are drawn from, rounds of a rotation's fit.
CODES, MEASURED, POOL, ROUNDS = 4, 16, 32, 30
#: Expected vectors of a bucket that one task looks up; larger buckets are looked up in slices.
SLICE = 1024
#: Longest part; chance that a pair at the limit shares no bucket.
LONGEST, MISS = 25, 1e-4
#: Bits of 64 x CODES that linked vectors may always differ in; random ones differ in half.
FAR = 88


def at_limit(unit: np.ndarray, cosine: float = COSINE, seed: int = 17) -> list[np.ndarray]:
    """Two partners for each row, with ``cosine`` to it: at random, and towards another row.
    A row without another direction is its own partner."""
    rng = np.random.default_rng(seed)
    across = rng.standard_normal(unit.shape) * (unit != 0)
    towards = np.roll(unit, int(rng.integers(1, max(len(unit), 2))), axis=0)
    found = []
    for turn in (across, towards):
        turn = turn - (turn * unit).sum(1, keepdims=True) * unit
        length = np.linalg.norm(turn, axis=1, keepdims=True)
        flat = length < 1e-9
        turned = cosine * unit + math.sqrt(max(0.0, 1 - cosine**2)) * turn / np.where(flat, 1, length)
        found.append(np.where(flat, unit, turned))
    return found


def n_tables(part: int, shares: np.ndarray) -> int:
    """Tables of ``part`` bits, one bit apart allowed, in which pairs meet but for ``MISS``.
    ``shares``, a row for each kind of pair, is the share of bits in which pairs differ."""
    apart = 1 - (1 - shares) ** part - part * shares * (1 - shares) ** (part - 1)
    apart = np.clip(apart, 0.0, 1 - 1e-12)

    def enough(tables: int) -> bool:
        return bool(((apart**tables).mean(1) <= MISS).all())

    most = 1
    while not enough(most):
        most *= 2
    least = most // 2 + 1 if most > 1 else 1
    while least < most:
        middle = (least + most) // 2
        least, most = (least, middle) if enough(middle) else (middle + 1, most)
    return most


def bits_apart(shares: np.ndarray) -> int:
    """Bits of 64 x CODES that pairs above the limit differ in at most."""
    spread = np.sqrt(shares.max() * (1 - shares.max()) / (64 * CODES))
    return max(FAR, math.ceil(64 * CODES * (shares.max() + 2 * spread)))


def plan(size: int, shares: np.ndarray) -> tuple[int, int]:
    """Bits of a part and tables with the fewest lookups and expected meetings of a vector in
    a label of ``size`` vectors."""
    choices = [(part, n_tables(part, shares)) for part in range(1, LONGEST + 1)]
    return min(choices, key=lambda c: c[1] * (c[0] + 1) * (1 + size / 2 ** c[0]))


class Rotations:
    """Centre, projection and ``codes`` rotations; 64 sign bits for each rotation."""

    def __init__(self, sample: np.ndarray, seed: int = 3, codes: int = CODES) -> None:
        self.width = sample.shape[1]
        self.mean = sample.mean(0)
        centred = sample - self.mean
        rng = np.random.default_rng(seed)
        kept = min(64, self.width)
        axes = np.linalg.svd(centred, full_matrices=False)[2][:kept].T if len(sample) > 1 else np.eye(self.width, kept)
        # Fewer axes than bits: further bits are signs of random mixtures of the axes.
        self.matrices = []
        flat = centred @ axes
        kept = axes.shape[1]
        for _ in range(codes):
            rotation = np.linalg.qr(rng.standard_normal((kept, kept)))[0]
            for _ in range(ROUNDS):
                left, _, right = np.linalg.svd(np.where(flat @ rotation >= 0, 1.0, -1.0).T @ flat)
                rotation = (left @ right).T
            more = rng.standard_normal((kept, 64 - kept))
            self.matrices.append(axes @ np.hstack([rotation, more]))

    def bits(self, unit: np.ndarray) -> np.ndarray:
        """Rows of 64 booleans for each code."""
        return np.hstack([(unit - self.mean) @ m >= 0 for m in self.matrices])

    def shares(self, unit: np.ndarray, cosine: float = COSINE) -> np.ndarray:
        """The share of bits in which rows differ from their partners at the limit."""
        own = self.bits(unit)
        return np.stack([(own != self.bits(other)).mean(1) for other in at_limit(unit, cosine)])


def _padded(vectors: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(vectors.offsets.to_numpy())
    table = np.zeros((len(vectors), width))
    table[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def _norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).view(np.int64).reshape(-1))
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(pa.int64()))


def n_codes(part: int, tables: int) -> int:
    return min(max(CODES, -(-part * tables // 64)), POOL)


def parts(bits: np.ndarray, part: int, tables: int) -> np.ndarray:
    """The value of each row's part in each table.  Parts share no bits as long as there are
    enough, then they come from further orders of all bits."""
    weights = np.int64(1) << np.arange(part, dtype=np.int64)
    rng = np.random.default_rng(29)
    whole = bits.shape[1] // part
    places = np.vstack(
        [rng.permutation(bits.shape[1])[: whole * part].reshape(whole, part) for _ in range(-(-tables // whole))]
    )
    return np.stack([bits[:, at] @ weights for at in places[:tables]], axis=1)


def _keys(nodes: DataFrame, rotations: Rotations, part: int, tables: int) -> DataFrame:
    """node, group, code and the values of its parts."""
    ship(nodes.sparkSession)
    shared = nodes.sparkSession.sparkContext.broadcast(rotations)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                rows = batch.slice(begin, 2048)
                bits = rotations.bits(_padded(rows.column("vector"), rotations.width))
                code = np.packbits(bits[:, : 64 * CODES], axis=1, bitorder="little").view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("node"), rows.column("group"), _lists(code), _lists(parts(bits, part, tables))],
                    names=["node", "group", "code", "parts"],
                )

    schema = "node string, group long, code array<long>, parts array<long>"
    return nodes.select("node", "group", "vector").mapInArrow(work, schema)


def linked_vectors(embeddings: DataFrame, cosine: float = COSINE, part: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.  ``part`` sets the bits of a
    part, which otherwise follow from the data (``plan``)."""
    vector = F.col("embedding").cast("array<double>")
    usable = F.col("label").isNotNull() & F.coalesce(
        (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & (F.col("norm") > 0)
        & (F.col("norm") < float("inf")),
        F.lit(False),
    )
    rows = embeddings.select("vec_id", "label", vector.alias("vector")).withColumn(
        "norm", _norm(F.transform("vector", lambda x: F.coalesce(x, F.lit(0.0))))
    )
    name = F.concat_ws("-", F.xxhash64("label", "vector"), F.xxhash64(F.lit(1), "vector", "label"))
    rows = saved(
        rows.select("vec_id", "label", "vector", "norm", F.when(usable, name).alias("node")), "vectors"
    )
    nodes = saved(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("vector").alias("vector"),
            F.any_value("norm").alias("norm"),
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("least"),
        )
        .withColumn("group", F.xxhash64("label", F.size("vector"))),
        "nodes",
    )
    sizes = nodes.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"))
    total, largest, width = sizes.agg(F.sum("n"), F.max("n"), F.max("width")).first()
    links = _links(nodes, total, largest, part, width, cosine) if total else None
    if links is None:
        answer = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return answer.withColumn("kept", F.lit(True))
    copies = nodes.select("node", "copies")
    both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    counts = (
        both.join(copies.select(F.col("node").alias("y"), "copies"), "y")
        .groupBy(F.col("x").alias("node"))
        .agg(F.sum("copies").alias("others"))
    )
    placed = nodes.select("node", "copies", "least").join(components(links), "node", "left").select(
        "node", "copies", "least", F.coalesce("component", "node").alias("component")
    )
    placed = saved(placed, "placed")
    firsts = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    found = placed.join(firsts, "component").join(counts, "node", "left").select(
        F.col("node").alias("__node"),
        "component_id",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
    )
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.join(found, rows["node"] == found["__node"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"),
    )


def _links(nodes: DataFrame, total: int, largest: int, part: int | None, width: int, cosine: float) -> DataFrame:
    share = int(min(1.0, SAMPLE / total) * (1 << 30))
    sample = nodes.where(F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 30)) < max(share, 1)).select("node", "vector")
    drawn = sorted(sample.limit(2 * SAMPLE).collect()) or nodes.select("node", "vector").orderBy("node").take(1)
    table = np.zeros((len(drawn), width))
    for k, (_, vector) in enumerate(drawn):
        table[k, : len(vector)] = vector
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    shares = Rotations(table, codes=MEASURED).shares(table, cosine)
    part, tables = (part, n_tables(part, shares)) if part else plan(largest, shares)
    far = bits_apart(shares)
    slices = -(-largest // (SLICE << part))
    rotations = Rotations(table, codes=n_codes(part, tables))
    keys = saved(_keys(nodes, rotations, part, tables), "keys")
    buckets = keys.select("node", "group", "code", F.posexplode("parts").alias("t", "value"))
    key = F.xxhash64("group", "t", "value", "slice").alias("key")
    held = buckets.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select(
        key, F.col("node").alias("y"), F.col("code").alias("y_code")
    )
    slice_ = F.pmod(F.xxhash64(F.lit(9), "node"), F.lit(slices)).cast("int")
    # A bucket's own value and those one bit away.
    turns = F.explode(F.array(*[F.lit(m).cast("long") for m in (0, *(1 << i for i in range(part)))]))
    asked = (
        buckets.withColumn("turn", turns)
        .withColumns({"value": F.col("value").bitwiseXOR(F.col("turn")), "slice": slice_})
        .select(key, F.col("node").alias("x"), F.col("code").alias("x_code"))
    )
    apart = F.aggregate(
        F.zip_with("x_code", "y_code", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, x: a + x
    )
    pairs = (
        asked.join(held.hint("merge"), "key")  # many rows from each row of a small table
        .where(F.col("x") < F.col("y"))
        .where(apart <= far)
        .select("x", "y")
        .distinct()
    )
    left = nodes.select(F.col("node").alias("x"), "group", F.col("vector").alias("a"), F.col("norm").alias("na"))
    right = nodes.select(
        F.col("node").alias("y"), F.col("group").alias("y_group"), F.col("vector").alias("b"), F.col("norm").alias("nb")
    )
    dot = F.aggregate(F.zip_with("a", "b", lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
    close = pairs.join(left, "x").join(right, "y").where("group = y_group").where(
        dot / F.col("na") / F.col("nb") >= cosine
    )
    return saved(close.select("x", "y"), "links")
