"""Removing repeated byte strings with sorted suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts somewhere else.  All
that such strings say is found at anchors: each string's ``GRAM``-byte gram of least hash
(the first of equals).  Equal strings have equal anchors at equal places, and one text
position in about seventy is an anchor, so only anchors are shuffled.

An anchor serves the strings that start dlo to dhi bytes before it.  Its context is their
bytes: those before the anchor, read backwards, and those from it on.  Anchors whose gram
occurs once are done.  Contexts that occur twice repeat in full.  The others are sorted with
those of the same gram, both halves, by deep-shallow sorting: multikey quicksort on
eight-byte characters to a shallow depth, then blind tries for groups that still agree.
From both orders and their common-prefix lengths follows, for each distance d, which
strings are equal: the same backward prefix of d bytes and a common forward prefix of
LENGTH - d.  Bytes are compared, not hashes.

A gram with more than ``CROWD`` anchors (a passage that many documents share) does not meet
in one task: digests (128 bits) of stretches of its contexts are counted, which combines
before the shuffle, down to the strings where a repeat begins or ends.  Documents equal as a whole are one text with a count.

Results for odd rows: a null text counts as empty; texts under LENGTH bytes lose nothing;
equal rows lose everything, whatever their ids; null and repeated ids are allowed; an empty
table gives an empty table.  Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbcast.llm.bytetext import BYTE, SMALL_SLICE, flat, mixed, slices
from kerbcast.llm.common import discard, saved, ship

LENGTH, GRAM = 200, 64
WINDOW = LENGTH - GRAM + 1
#: Bytes that quicksort looks at; anchors of a gram beyond which it is counted, not sorted.
SHALLOW, CROWD = 96, 256
#: Distances that are counted together, in the steps of the search in crowded grams.
STRETCHES = (32, 8, 2, 1)
#: Contexts sorted together in a task; bounds its memory.
CHUNK = 6000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor places, their grams' hashes, and dlo and dhi; places in order."""
    n = len(data)
    nothing = np.zeros(0, np.int64)
    if n < LENGTH:
        return nothing, nothing.astype(np.uint64), nothing, nothing
    # A gram's hash from running sums, shifted back to its start.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * _powers(_BASE, n))))
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * _powers(_INVERSE, n - GRAM + 1))
    bits = np.uint64(max(21, n.bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = WINDOW - step
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & low).astype(np.int64)  # of the string that starts here
    inside = np.zeros(n + 1, np.int64)
    full = np.diff(offsets) >= LENGTH
    np.add.at(inside, offsets[:-1][full], 1)
    np.add.at(inside, offsets[1:][full] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[: len(at)] > 0)
    at = at[starts]
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else nothing
    last = np.concatenate((new[1:], [len(at)])) - 1 if len(at) else nothing
    place = at[new]
    return place, grams[place], place - starts[last], place - starts[new]


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    apart = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (apart.bit_length() + 7) // 8


class _Branch:
    __slots__ = ("children", "depth")

    def __init__(self, depth: int, children: dict) -> None:
        self.depth, self.children = depth, children


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes]) -> list[bytes]:
    """Distinct strings in order: a trie that keeps only the bytes where strings part; each
    string finds a leaf without looking at the bytes between, is compared with it once, and
    goes in where the two part."""
    root: _Branch | bytes = strings[0]
    for s in strings[1:]:
        node = root
        while isinstance(node, _Branch):
            node = node.children.get(_byte(s, node.depth)) or next(iter(node.children.values()))
        shared = common(s, node)
        above, node = None, root
        while isinstance(node, _Branch) and node.depth < shared:
            above, node = node, node.children[_byte(s, node.depth)]
        if isinstance(node, _Branch) and node.depth == shared:
            node.children[_byte(s, shared)] = s
            continue
        leaf = node
        while isinstance(leaf, _Branch):
            leaf = next(iter(leaf.children.values()))
        branch = _Branch(shared, {_byte(leaf, shared): node, _byte(s, shared): s})
        if above is None:
            root = branch
        else:
            above.children[_byte(s, above.depth)] = branch
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack += [node.children[b] for b in sorted(node.children, reverse=True)]
        else:
            out.append(node)
    return out


def deep_shallow(strings: list[bytes]) -> list[bytes]:
    """Distinct strings in order."""
    out: list[bytes] = []
    stack = [(strings, 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) < 2:
            out += group
        elif depth >= SHALLOW:
            out += blind_trie(group)
        else:
            keys = [s[depth : depth + 8] for s in group]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            below = [s for s, k in zip(group, keys, strict=True) if k < pivot]
            equal = [s for s, k in zip(group, keys, strict=True) if k == pivot]
            above = [s for s, k in zip(group, keys, strict=True) if k > pivot]
            stack += [(above, depth), (equal, depth + 8), (below, depth)]
    return out


def _ranked(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each string's rank among the distinct ones, and the common prefix of each distinct
    string with the one before it."""
    order = deep_shallow(list(set(strings)))
    rank = {s: k for k, s in enumerate(order)}
    shared = [0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)]
    return np.array([rank[s] for s in strings], np.int64), np.array(shared, np.int64)


def _least_between(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs whose length is a power of two."""
    levels = [values]
    step = 1
    while 2 * step <= len(values):
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
        step *= 2
    return levels


def repeated_distances(
    before: list[bytes], after: list[bytes], dlo: np.ndarray, dhi: np.ndarray
) -> np.ndarray:
    """For each context and distance: whether its string at that distance is another
    context's too.  ``before`` is read backwards."""
    back, back_shared = _ranked(before)
    on, on_shared = _ranked(after)
    levels = _least_between(on_shared)
    found = np.zeros((len(before), WINDOW), bool)
    for d in range(int(dlo.min()), int(dhi.max()) + 1):
        own = np.flatnonzero((dlo <= d) & (d <= dhi))
        if len(own) < 2:
            continue
        kind = np.cumsum(back_shared < d)[back[own]]
        order = np.lexsort((on[own], kind))
        own, kind = own[order], kind[order]
        low, high = on[own[:-1]], on[own[1:]]
        width = high - low
        level = np.frexp(np.maximum(width, 1))[1] - 1
        shared = np.full(len(width), LENGTH)
        for k in np.unique(level[width > 0]):
            at = np.flatnonzero((level == k) & (width > 0))
            shared[at] = np.minimum(levels[k][low[at] + 1], levels[k][high[at] + 1 - (1 << int(k))])
        same = (kind[1:] == kind[:-1]) & (shared >= LENGTH - d)
        found[own[1:][same], d] = True
        found[own[:-1][same], d] = True
    return found


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _scan(documents: DataFrame, text: str) -> DataFrame:
    """doc_id, n_bytes, sha256 and digest of each text, and the hashes of its anchors."""
    ship(documents.sparkSession)
    longs = T.ArrayType(T.LongType(), False)
    schema = T.StructType([documents.schema["doc_id"]]).add("n_bytes", T.LongType(), False)
    schema = schema.add("whole", T.StringType(), False).add("digest", T.BinaryType(), False).add("grams", longs, False)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", SMALL_SLICE):  # anchors take 150 bytes a byte of text
                data, offsets = flat(part.column("__text"))
                raw = data.tobytes()
                texts = [raw[b:e] for b, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                place, grams, _, _ = anchors(data, offsets)
                bounds = np.searchsorted(place, offsets).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array([_digest(t) for t in texts], pa.binary()),
                        pa.ListArray.from_arrays(bounds, pa.array(grams.view(np.int64))),
                    ],
                    names=schema.names,
                )

    return documents.select("doc_id", documents[text].alias("__text")).mapInArrow(work, schema)


def _contexts(texts: DataFrame) -> DataFrame:
    """A row for each asked anchor of texts (text, digest, rid, asked): its context."""
    schema = (
        "rid long, place int, dlo int, dhi int, crowded boolean, gram long, context binary, before binary, after binary"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("rid", "digest", "asked")]
            for k, (rid, digest, asked) in enumerate(zip(*columns, strict=True)):
                raw = (batch.column("text")[k].as_py() or "").encode()
                if _digest(raw) != digest:
                    continue  # another text of the same id
                data = np.frombuffer(raw, np.uint8)
                place, grams, dlo, dhi = anchors(data, np.array([0, len(raw)]))
                crowded = {a["at"]: a["crowded"] for a in asked}
                rows = sorted(crowded)
                before = [raw[place[i] - dhi[i] : place[i]][::-1] for i in rows]
                after = [raw[place[i] : place[i] - dlo[i] + LENGTH] for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rid] * len(rows), pa.int64()),
                        *[pa.array(x[rows].astype(np.int32)) for x in (place, dlo, dhi)],
                        pa.array([crowded[i] for i in rows]),
                        pa.array(grams[rows].view(np.int64)),
                        pa.array([_digest(b"%d " % len(x) + x + y) for x, y in zip(before, after, strict=True)], pa.binary()),
                        pa.array(before, pa.binary()),
                        pa.array(after, pa.binary()),
                    ],
                    names=names,
                )

    return texts.mapInArrow(work, schema)


_FOUND = "context binary, spans array<struct<low:int,high:int>>"


def _sorted(contexts: DataFrame) -> DataFrame:
    """context and the distances at which it repeats, for grams that stay together."""

    def answer(rows: dict[str, list]) -> pa.RecordBatch:
        dlo, dhi = np.array(rows["dlo"]), np.array(rows["dhi"])
        found = repeated_distances(rows["before"], rows["after"], dlo, dhi)
        hits = [k for k in np.flatnonzero(found.any(1)).tolist() if rows["n"][k] == 1]
        spans = [[{"low": a, "high": b} for a, b in _spans(found[k])] for k in hits]
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([rows["context"][k] for k in hits], pa.binary()), pa.array(spans, kind)], names=["context", "spans"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                held.setdefault(name, []).extend(column.to_pylist())
            while len(held["gram"]) > 2 * CHUNK:
                cut = CHUNK
                while cut < len(held["gram"]) and held["gram"][cut] == held["gram"][cut - 1]:
                    cut += 1
                if cut == len(held["gram"]):
                    break
                yield answer({n: c[:cut] for n, c in held.items()})
                held = {n: c[cut:] for n, c in held.items()}
        if held.get("gram"):
            yield answer(held)

    rows = contexts.select("gram", "context", "before", "after", "dlo", "dhi", "n")
    return rows.repartition("gram").sortWithinPartitions("gram").mapInArrow(work, _FOUND)


def _ranges(contexts: DataFrame, width: int) -> DataFrame:
    """A row for each stretch of ``width`` distances that a context's ranges touch: the bytes
    that all its strings share (core), those of all of them together (whole; null where the
    context does not reach over the stretch), and whether the range is still without an
    answer and its context in one place (once)."""
    schema = "context binary, low int, high int, core binary, whole binary, once boolean"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                rows = []
                for r in batch.slice(begin, 500).to_pylist():
                    text, zero = r["before"][::-1] + r["after"], len(r["before"])
                    stretches = {d // width: p["once"] for p in r["ranges"] for d in range(max(p["low"], r["dlo"]), min(p["high"], r["dhi"]) + 1)}
                    for low, once in sorted((width * s, once) for s, once in stretches.items()):
                        high = low + width - 1
                        core = _digest(b"%d " % low + text[zero - low : zero - high + LENGTH])
                        whole = None
                        if r["dlo"] <= low and high <= r["dhi"]:
                            whole = _digest(b"%d " % low + text[zero - high : zero - low + LENGTH])
                        rows.append((r["context"], low, high, core, whole, once))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return contexts.mapInArrow(work, schema)


def _counted(contexts: DataFrame) -> DataFrame:
    """The same for crowded grams, by counting digests.

    Distances are taken in stretches.  Where the whole of a stretch occurs twice, all its
    strings repeat; where its core occurs once, none does; else it is cut into shorter
    stretches, down to single strings.  Of the contexts that share a settled stretch only
    one goes on with it, as a witness for others that share a part.  So a context costs a
    few rows for each edge of what it shares, not one for each string.
    """
    rows = contexts.select("context", "before", "after", "dlo", "dhi")
    start = F.array(F.struct(F.col("dlo").alias("low"), F.col("dhi").alias("high"), (F.col("n") == 1).alias("once")))
    open_ = contexts.select(*rows.columns, start.alias("ranges"))
    answers, read = [], ()
    for width in STRETCHES:
        cut = saved(_ranges(open_, width), "stretches")
        discard(*read)
        # Wholes that occur once are told by a count, so the many that occur often stay in place.
        held = cut.where("whole IS NOT NULL")
        own = F.any_value(F.struct("context", "low", "high", "core", "once")).alias("own")
        kinds = held.groupBy("whole").agg(F.count(F.lit(1)).alias("held"), own)
        kinds = saved(kinds.select("own.context", "own.low", "own.high", "own.core", (F.col("own.once") & (F.col("held") == 1)).alias("once")), "kinds")
        place, none = F.struct("low", "high"), F.lit(None).cast("struct<low:int,high:int>")
        told = held.where("once").select("context", place.alias("whole"), none.alias("alone"))
        told = told.unionByName(kinds.where("once").select("context", none.alias("whole"), place.alias("alone")))
        spans = F.array_except(F.collect_list("whole"), F.collect_list("alone")).alias("spans")
        answers.append(saved(told.groupBy("context").agg(spans).where(F.size("spans") > 0), "settled"))
        # Cores that two contexts have, and at least one of them without an answer yet.
        left = cut.where("whole IS NULL").select(*kinds.columns).unionByName(kinds)
        cores = left.groupBy("core").agg(F.count(F.lit(1)).alias("held"), F.bool_or("once").alias("open")).where("held > 1 AND open")
        cores = saved(cores.select("core"), "cores")
        further = left.join(cores, "core", "left_semi")
        ranges = further.groupBy("context").agg(F.collect_list(F.struct("low", "high", "once")).alias("ranges"))
        open_ = rows.join(ranges, "context")
        read = (cut, kinds, cores)
    discard(*read)
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    return found.groupBy("context").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(texts: DataFrame) -> DataFrame:
    """rid, n_removed, n_spans and kept_sha256 of texts (text, digest, rid, runs)."""
    schema = "rid long, n_removed long, n_spans long, kept_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, (rid, digest, spans) in enumerate(
                zip(*[batch.column(c).to_pylist() for c in ("rid", "digest", "runs")], strict=True)
            ):
                raw = (batch.column("text")[k].as_py() or "").encode()
                if _digest(raw) != digest:
                    continue
                kept, at, removed, count = hashlib.sha256(), 0, 0, 0
                for begin, end in merged([(s["begin"], s["end"]) for s in spans]):
                    kept.update(raw[at:begin])
                    at, removed, count = end, removed + end - begin, count + 1
                kept.update(raw[at:])
                rows.append((rid, removed, count, kept.hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["rid", "n_removed", "n_spans", "kept_sha256"],
            )

    return texts.mapInArrow(work, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def repeats_removed(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    scan = saved(_scan(documents, text).withColumn("rid", F.monotonically_increasing_id()), "scan")
    texts = scan.groupBy("digest").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies"))
    texts = saved(texts, "texts")
    once = scan.join(texts.select("rid"), "rid", "left_semi").select("rid", F.posexplode("grams").alias("at", "gram"))
    once = saved(once, "anchors")
    # Saved, so that the join reads two plain shuffles and a crowded gram's rows can be split.
    shared = saved(once.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    asked = (
        once.join(shared, "gram")
        .groupBy("rid")
        .agg(F.collect_list(F.struct("at", (F.col("n") > CROWD).alias("crowded"))).alias("asked"))
    )
    heads = scan.select("rid", "digest", F.col("doc_id").alias("__id"))
    body = documents.select(F.col("doc_id").alias("__doc"), F.col(text).alias("text"))
    named = asked.join(heads, "rid")
    met = body.join(named, F.col("__doc").eqNullSafe(F.col("__id"))).select("text", "digest", "rid", "asked")
    wide = saved(_contexts(met), "contexts")
    discard(once, shared)
    contexts = saved(
        wide.groupBy("context").agg(
            *[F.any_value(c).alias(c) for c in ("gram", "crowded", "before", "after", "dlo", "dhi")],
            F.count(F.lit(1)).alias("n"),
        ),
        "distinct",
    )
    rows = saved(wide.select("rid", "place", "context"), "places")
    discard(wide)
    partial = _sorted(contexts.where("NOT crowded")).unionByName(_counted(contexts.where("crowded")))
    whole = contexts.where("n > 1").select("context", F.array(F.struct(F.col("dlo").alias("low"), F.col("dhi").alias("high"))).alias("spans"))
    repeats = rows.join(partial.unionByName(whole), "context")
    runs = repeats.select("rid", "place", F.explode("spans").alias("s")).groupBy("rid").agg(
        F.collect_list(
            F.struct((F.col("place") - F.col("s.high")).alias("begin"), (F.col("place") - F.col("s.low") + LENGTH).alias("end"))
        ).alias("runs")
    )
    alone = runs.join(texts.where("copies = 1").select("rid"), "rid", "left_semi").join(heads, "rid")
    parts = body.join(alone, F.col("__doc").eqNullSafe(F.col("__id"))).select("text", "digest", "rid", "runs")
    cut = _cut(parts).withColumnRenamed("rid", "__rid")
    judged = scan.drop("grams").join(texts.select("digest", "copies"), "digest")
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return judged.join(cut, judged["rid"] == cut["__rid"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
