"""Document fingerprints from prefix polynomial hashes.

The code points of a text are the coefficients of a polynomial, whose running sums modulo two
primes are the prefix arrays.  From two places of the arrays follows the hash of the span
between them, so any two spans are compared in constant time, and the longest common
extension of two places is found by binary search (``Prefixes``).

A fingerprint is a prefix array thinned out to two kinds of places.  The ``ANCHORS`` places
with the smallest hashes of the ``WINDOW`` code points before them (all or none of those with
equal hashes) are the same wherever an equal passage stands; ``limit`` is the smallest hash
left out.  Eight to fifteen places at multiples of a power of two, a grid, hold on to equal
beginnings that anchors miss, as in texts of one repeated word.  Of two fingerprints, spans
between anchors below the smaller limit are looked up in the other and extended by binary
search, and the longest common beginning is searched over all places that both have.  The
likeness is the share of both texts' code points in what the other has too.

As text a fingerprint reads ``chars.limit.`` and then, in base 64, four little-endian 32-bit
numbers for each place and the end: position, anchor's hash (all ones for places of the grid
alone), and the two hashes of what stands before.

Results for odd rows: a null text counts as empty; two empty texts are alike (1.0), an empty
and another are not (0.0); rows of one id follow each other by a hash of their texts, null ids
come last; a single row is its own next document; an empty table gives an empty table.  A text
and its arrays (about 200 bytes a code point) must fit a task.  Extra columns of any name are
left alone.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.bytetext import mixed, slices
from kerbcast.llm.common import ship

#: Places kept by their hashes at most, code points that choose such a place, shortest span
#: that counts away from both ends, bytes of text handled at once.
ANCHORS, WINDOW, SHORTEST, SLICE = 32, 8, 8, 256 << 10
#: Bits of an anchor's hash; what stands for none in writing.
BITS, NO_ANCHOR = 30, 2**32 - 1
#: Both primes are 2^31 - 1 or less, so products and a billion terms stay within 63 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo the prime, by doubling."""
    table = np.ones(1, np.int64)
    step = base
    while len(table) < n:
        table = np.concatenate([table, table * step % prime])
        step = step * step % prime
    return table[:n]


class _Tables:
    """Powers and inverse powers, grown as longer texts come."""

    def __init__(self) -> None:
        self.n, self.up, self.down = 0, (), ()

    def reach(self, n: int) -> _Tables:
        if n > self.n:
            self.n = max(n, 1 << 16)
            self.up = [_powers(b, p, self.n) for b, p in zip(BASES, PRIMES, strict=True)]
            self.down = [_powers(pow(b, -1, p), p, self.n) for b, p in zip(BASES, PRIMES, strict=True)]
        return self


TABLES = _Tables()


class Prefixes:
    """Modular prefix arrays over code points; hashes of spans do not depend on their place."""

    def __init__(self, points: np.ndarray) -> None:
        tables = TABLES.reach(len(points) + 1)
        coded = points.astype(np.int64) + 1
        self.sums = []
        for up, prime in zip(tables.up, PRIMES, strict=True):
            sums = np.zeros(len(points) + 1, np.int64)
            np.cumsum(coded * up[: len(points)] % prime, out=sums[1:])
            sums %= prime
            self.sums.append(sums)

    def __len__(self) -> int:
        return len(self.sums[0]) - 1

    def spans(self, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Hashes of the spans [begin, end) modulo one prime."""
        sums, prime = self.sums[which], PRIMES[which]
        return (sums[end] - sums[begin]) % prime * TABLES.down[which][begin] % prime

    def span(self, begin: int, end: int) -> tuple[int, int]:
        return tuple(int(self.spans(np.array([begin]), np.array([end]), k)[0]) for k in range(2))

    def extension(self, at: int, other: Prefixes, other_at: int) -> int:
        """Code points that agree from these places on: a binary search over lengths."""
        low, high = 0, min(len(self) - at, len(other) - other_at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(at, at + middle) == other.span(other_at, other_at + middle):
                low = middle
            else:
                high = middle - 1
        return low


@dataclass(frozen=True)
class Fingerprint:
    """Places of a text, the last at its end, with the hashes of what stands before them."""

    chars: int
    limit: int
    places: list[int]
    anchors: list[int | None]
    hashes: list[tuple[int, int]]

    def written(self) -> str:
        table = np.empty((len(self.places), 4), "<u4")
        table[:, 0] = self.places
        table[:, 1] = [NO_ANCHOR if anchor is None else anchor for anchor in self.anchors]
        table[:, 2:] = self.hashes
        return f"{self.chars}.{self.limit}.{base64.b64encode(table.tobytes()).decode()}"

    @staticmethod
    def read(text: str) -> Fingerprint:
        chars, limit, entries = text.split(".")
        table = np.frombuffer(base64.b64decode(entries), "<u4").reshape(-1, 4).tolist()
        return Fingerprint(
            int(chars),
            int(limit),
            [row[0] for row in table],
            [None if row[1] == NO_ANCHOR else row[1] for row in table],
            [(row[2], row[3]) for row in table],
        )


def spacing(chars: int) -> int:
    """The grid's power of two: eight to fifteen places."""
    return 1 << max(0, chars.bit_length() - 4)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row, and where each text begins and the last ends."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def _anchored(prefixes: Prefixes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, place, hash) of all texts' anchors by owner and hash, and each text's limit."""
    n = len(offsets) - 1
    inner = np.maximum(np.diff(offsets) - 1, 0)
    owner = np.repeat(np.arange(n), inner)
    places = np.arange(len(owner)) - np.repeat(np.cumsum(inner) - inner, inner) + 1 + offsets[owner]
    windows = prefixes.spans(np.maximum(places - WINDOW, offsets[owner]), places, 0)
    values = (mixed(windows.astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - BITS)).astype(np.int64)
    # Halve the range of hashes while more than enough places are in it; sort only the rest.
    digits = np.frexp(values.astype(float))[1]
    counts = np.bincount(owner * (BITS + 1) + digits, minlength=n * (BITS + 1)).reshape(n, -1).cumsum(1)
    enough = (counts <= ANCHORS).sum(1)
    near = digits <= enough[owner]
    owner, places, values = owner[near], places[near], values[near]
    order = np.lexsort((places, values, owner))
    owner, places, values = owner[order], places[order], values[order]
    starts = np.searchsorted(owner, np.arange(n))
    sizes = np.bincount(owner, minlength=n)
    limits = np.full(n, 1 << BITS, np.int64)
    over = sizes > ANCHORS
    limits[over] = values[starts[over] + ANCHORS]
    kept = values < limits[owner]
    return owner[kept], places[kept] - offsets[owner[kept]], values[kept], limits


def fingerprints(texts: list[str]) -> list[Fingerprint]:
    """One for each text, over one prefix array of all of them."""
    if not texts:
        return []
    points, offsets = code_points(texts)
    prefixes = Prefixes(points)
    owner, places, values, limits = _anchored(prefixes, offsets)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    chosen, anchors = [], []
    for t, text in enumerate(texts):
        own = slice(bounds[t], bounds[t + 1])
        found = dict.fromkeys(range(spacing(len(text)), len(text), spacing(len(text))))
        found.update(zip(places[own].tolist(), values[own].tolist(), strict=True))
        found.pop(len(text), None)
        kept = sorted(found)
        chosen.append([*kept, len(text)])
        anchors.append([*map(found.get, kept), None])
    sizes = [len(c) for c in chosen]
    begins = np.repeat(offsets[:-1], sizes)
    ends = begins + np.fromiter((at for own in chosen for at in own), np.int64, sum(sizes))
    hashes = list(zip(*(prefixes.spans(begins, ends, k).tolist() for k in range(2)), strict=True))
    out, at = [], 0
    for t, text in enumerate(texts):
        out.append(Fingerprint(len(text), int(limits[t]), chosen[t], anchors[t], hashes[at : at + sizes[t]]))
        at += sizes[t]
    return out


class _Chain:
    """A fingerprint's anchors that another would keep too, with both ends."""

    def __init__(self, print_: Fingerprint, limit: int) -> None:
        kept = [k for k, anchor in enumerate(print_.anchors) if anchor is not None and anchor < limit]
        self.places = [0, *(print_.places[k] for k in kept), print_.chars]
        self.hashes = [(0, 0), *(print_.hashes[k] for k in kept), print_.hashes[-1]]
        self.p, self.q = PRIMES
        TABLES.reach(print_.chars + 1)
        first, second = TABLES.down
        self.turns = [(int(first[at]), int(second[at])) for at in self.places]

    def span(self, i: int, j: int) -> tuple[int, int, int]:
        """Length and hashes of the span between two places."""
        (a, b), (c, d), (x, y) = self.hashes[i], self.hashes[j], self.turns[i]
        return self.places[j] - self.places[i], (c - a) % self.p * x % self.p, (d - b) % self.q * y % self.q

    def index(self) -> dict[tuple[int, int, int], list[int]]:
        found = defaultdict(list)
        for i in range(len(self.places) - 1):
            found[self.span(i, i + 1)].append(i)
        return found

    def extension(self, i: int, other: _Chain, j: int) -> int:
        """Spans that agree from these places on: a binary search over their number."""
        low, high = 1, min(len(self.places) - i, len(other.places) - j) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(i, i + middle) == other.span(j, j + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def covered(self, other: _Chain, index: dict, common: int) -> int:
        """Code points in the common beginning, and in spans that the other has too."""
        i, total, last = 0, common, len(self.places) - 1
        while i < last:
            best = 0
            for j in index.get(self.span(i, i + 1), ()):
                reach = self.extension(i, other, j)
                end = i + reach == last and j + reach == len(other.places) - 1
                if reach > best and (end or self.places[i + reach] - self.places[i] >= SHORTEST):
                    best = reach
            total += max(self.places[i + best] - max(self.places[i], common), 0)
            i += best or 1
        return total


def common_beginning(a: Fingerprint, b: Fingerprint) -> int:
    """The last place of both before which the texts are equal: a binary search."""
    hashes = dict(zip(b.places, b.hashes, strict=True))
    both = [(at, own == hashes[at]) for at, own in zip(a.places, a.hashes, strict=True) if at in hashes]
    low, high = 0, len(both)
    while low < high:
        middle = (low + high) // 2
        if both[middle][1]:
            low = middle + 1
        else:
            high = middle
    return both[low - 1][0] if low else 0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """The share of both texts' code points that lie in spans the other has too."""
    if a.chars == b.chars and a.hashes[-1] == b.hashes[-1]:
        return 1.0
    if not a.chars or not b.chars:
        return 0.0
    common, limit = common_beginning(a, b), min(a.limit, b.limit)
    x, y = _Chain(a, limit), _Chain(b, limit)
    in_x, in_y = x.index(), y.index()
    if in_x.keys().isdisjoint(in_y):
        return 2 * common / (a.chars + b.chars)
    return (x.covered(y, in_y, common) + y.covered(x, in_x, common)) / (a.chars + b.chars)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of another."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(ids: list, texts: list[str], prints: list[Fingerprint]) -> list[list]:
    """Columns for every text but the last, each beside the one after it."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    changed_prints = fingerprints(changed)
    return [
        ids[:-1],
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        [p.written() for p in prints[:-1]],
        [p.written() for p in changed_prints],
        [likeness(p, q) for p, q in zip(prints, changed_prints, strict=False)],
        [likeness(p, q) for p, q in zip(prints, prints[1:], strict=False)],
    ]


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [part.split()[0] for part in COLUMNS.split(", ")]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition, each beside the next; the guest at its end is no row of
    its own (equal guests after the first say nothing new)."""
    held = None
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            ids, texts = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
            guests = rows.column("guest").to_numpy(zero_copy_only=False)
            last = guests.any()
            if last:
                ids, texts = ids[: guests.argmax() + 1], texts[: guests.argmax() + 1]
            prints = fingerprints(texts)
            if held is not None:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
            columns = _compared(ids, texts, prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
            )
            if last:
                return
            held = ids[-1], texts[-1], prints[-1]


def _stretches(heads: list[tuple[int, int]]) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """For the key of a row, twice the number of the stretch it belongs to, plus one if it is
    the first key of it."""
    ranks = np.array([rank for rank, _ in heads])

    def number(rank: pa.Array, mark: pa.Array) -> pa.Array:
        own = rank.to_numpy()
        low, high = np.searchsorted(ranks, own, "left"), np.searchsorted(ranks, own, "right")
        found = 2 * (high - 1)
        # Stretches that begin within one rank are told apart by the mark.
        tied = np.flatnonzero(low < high)
        marks = mark.take(pa.array(tied)).to_pylist()
        for k, value in zip(tied.tolist(), marks, strict=True):
            key = (int(own[k]), value)
            at = bisect_right(heads, key, int(low[k]), int(high[k])) - 1
            found[k] = 2 * at + (at >= 0 and heads[at] == key)
        return pa.array(found, pa.int64())

    return number


def fingerprinted(documents: DataFrame) -> DataFrame:
    """Each document beside its edited text and the next document, by falling id.

    Keys alone (id and a hash of the text, 16 bytes) are range-partitioned first; the first
    key of each partition, one for each shuffle partition of the session, cuts the order into
    stretches.  Texts are then shuffled once, each to its stretch, the first of a stretch also
    to the end of the one before as a guest.  Tasks read their sorted stretch as a stream.
    """
    spark = documents.sparkSession
    ship(spark)
    doc_id = F.col("doc_id").cast("long")
    rows = documents.select(
        doc_id.alias("doc_id"),
        F.coalesce(F.bitwise_not(doc_id), F.lit(2**63 - 1)).alias("rank"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("rank", "mark").repartitionByRange(n, "rank", "mark")
    firsts = keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("rank", "mark")).alias("first"))
    heads = sorted((r["first"]["rank"], r["first"]["mark"]) for r in firsts.collect())
    if not heads:
        return spark.createDataFrame([], COLUMNS)
    number = F.arrow_udf(_stretches(heads), "long")(F.col("rank"), F.col("mark"))
    stretch = F.floor(F.col("number") / 2).cast("int")
    own = F.struct(stretch.alias("stretch"), F.lit(False).alias("guest"))
    before = F.struct(((stretch + len(heads) - 1) % len(heads)).alias("stretch"), F.lit(True).alias("guest"))
    places = F.when(F.col("number") % 2 == 1, F.array(own, before)).otherwise(F.array(own))
    dealt = rows.withColumn("number", number).withColumn("place", F.explode(places)).select(
        "doc_id", "rank", "mark", "text", "place.*"
    )
    return (
        dealt.repartitionById(len(heads), "stretch")
        .sortWithinPartitions("guest", "rank", "mark", "text")
        .select("doc_id", "text", "guest")
        .mapInArrow(_in_order, COLUMNS)
    )
