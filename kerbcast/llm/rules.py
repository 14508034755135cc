"""Quality rules: counts by rule, and an isolation forest over what they say of a text.

Words are runs of anything but the six ASCII blanks.  Counts are made over whole texts;
documents that fail a fixed rule are out.  The others get an anomaly score: the forest is
grown on a bounded sample (``SAMPLE`` rows by hash, from rows labelled good where there are
labels), each tree on ``TREE_ROWS`` of them, with random splits over the whole range that a
statistic has in the corpus; a text whose path to a leaf is short on average lies where good
texts are few.  The score from which a text is rejected is set over all labelled rows: it
rejects at most ``SPARE`` of those labelled good, and lies midway between the lowest such
score and the highest that still rejects nearly as many of the others.

Results for odd rows: a null text counts as empty, has zero counts and fails the rules; a
null id is scored and carries no label; repeated rows are judged alike; without labels of
both kinds only the fixed rules reject; an empty table gives an empty table.  Extra columns
of any name are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbcast.llm.bytetext import IS_WORD, SMALL_SLICE, flat, mixed, random_words, run_hashes, runs, slices
from kerbcast.llm.common import saved, ship

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
#: Bounds of what the forest learns from, whatever the corpus holds.
SAMPLE, TREE_ROWS, TREES, DEPTH = 8192, 256, 100, 10
#: Share of rows labelled good that the threshold may reject.
SPARE = 0.0005
SCORE_BINS = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: A further count that only the forest uses.
SHAPES = ("n_distinct",)
_TRIPLE = random_words(31, 4)
_IS = {
    "symbol": np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8)),
    "start": (np.arange(256) & 0xC0) != 0x80,
}


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs more than once, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    ordered = keys[order]
    same[1:-1] = ordered[1:] == ordered[:-1]
    often, before = np.empty(len(keys), bool), np.empty(len(keys), bool)
    often[order], before[order] = same[:-1] | same[1:], same[:-1]
    return often, before


def _counts(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = flat(texts)
    n = len(texts)
    starts, ends, of = runs(IS_WORD[data], offsets)
    hashes = run_hashes(data, starts, ends)
    own = mixed(np.arange(n, dtype=np.uint64) + np.uint64(1))
    out = {"n_words": np.bincount(of, minlength=n)}
    begun = np.concatenate(([0], np.cumsum(_IS["start"][data])))
    sizes = begun[ends] - begun[starts]
    out["word_chars"] = np.bincount(of, sizes, n).astype(np.int64)
    out["n_symbols"] = _sums(_IS["symbol"][data], offsets)
    out["n_distinct"] = np.bincount(of[~_again(hashes ^ own[of])[1]], minlength=n)
    marked = np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        inside = of[2:] == of[:-2]
        triple = mixed(sum(hashes[k : len(hashes) - 2 + k] * _TRIPLE[k] for k in range(3)))
        first = np.flatnonzero(inside)[_again((triple ^ own[of[2:]])[inside])[0]]
        for k in range(3):
            marked[first + k] = True
    out["n_repeat_words"] = np.bincount(of[marked], minlength=n)
    line_starts, line_ends, line_of = runs(data != 10, offsets)
    worded = np.concatenate(([0], np.cumsum(IS_WORD[data])))
    full = worded[line_ends] > worded[line_starts]
    line_starts, line_ends, line_of = line_starts[full], line_ends[full], line_of[full]
    lines = run_hashes(data, line_starts, line_ends)
    out["n_dup_lines"] = np.bincount(line_of[_again(lines ^ own[line_of])[1]], minlength=n)
    return out


def rule_counts(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the counts of every text, in one pass."""
    ship(documents.sparkSession)
    names = [*COUNTS, *SHAPES]
    schema = T.StructType(
        [documents.schema[k] for k in keep] + [T.StructField(n, T.LongType(), False) for n in names]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", SMALL_SLICE):
                counts = _counts(part.column("__text"))
                columns = [part.column(k) for k in keep] + [pa.array(counts[n].astype(np.int64)) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return documents.select(*keep, documents[text].alias("__text")).mapInArrow(work, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


def statistics(counts: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest sees of a text: shares and means of the counts, within fixed ranges."""
    words = np.maximum(counts["n_words"], 1).astype(float)
    return np.column_stack(
        [
            np.minimum(counts["word_chars"] / words, 16.0),
            np.minimum(counts["n_symbols"] / words, 1.0),
            np.minimum(counts["n_repeat_words"] / words, 0.5),
            np.minimum(counts["n_distinct"] / words**0.9, 2.0),
        ]
    )


class Forest:
    """Isolation trees as arrays; the same rows and seed give the same trees."""

    def __init__(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        size = min(TREE_ROWS, len(rows))
        nodes = 2 ** (DEPTH + 1)
        self.feature = np.zeros((TREES, nodes), np.int32)
        self.cut = np.full((TREES, nodes), np.inf)
        self.length = np.zeros((TREES, nodes))
        for t in range(TREES):
            self._grow(t, 1, 0, rows[rng.choice(len(rows), size, replace=False)], low, high, rng)
        self.norm = max(_usual(size), 1.0)

    def _grow(self, t, node, depth, rows, low, high, rng) -> None:
        """Split the box [low, high) that holds ``rows`` of tree t at ``node``."""
        open_ = np.flatnonzero(high > low)
        if depth == DEPTH or len(rows) <= 1 or not len(open_):
            while node < self.length.shape[1]:  # a leaf's rows go on to its leftmost heir
                self.length[t, node] = depth + _usual(len(rows))
                node *= 2
            return
        f = int(rng.choice(open_))
        cut = float(rng.uniform(low[f], high[f]))
        self.feature[t, node], self.cut[t, node] = f, cut
        left, below, above = rows[:, f] < cut, high.copy(), low.copy()
        below[f] = above[f] = cut
        self._grow(t, 2 * node, depth + 1, rows[left], low, below, rng)
        self._grow(t, 2 * node + 1, depth + 1, rows[~left], above, high, rng)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1 for texts that few splits set apart, near or below a half for usual ones."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for t in range(len(self.cut)):
            node = np.ones(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + (rows[every, self.feature[t, node]] >= self.cut[t, node])
            total += self.length[t, node]
        return 2.0 ** (-total / len(self.cut) / self.norm)


def _usual(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class Judge:
    """A forest and the score from which a text is rejected."""

    def __init__(self, forest: Forest | None, limit: float) -> None:
        self.forest, self.limit = forest, limit

    def scores(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        table = statistics(counts)
        return self.forest.score(table) if self.forest else np.zeros(len(table))

    def kept(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        failed = (counts["n_words"] < MIN_WORDS) | (
            100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
        )
        return ~failed & (self.scores(counts) < self.limit)


def fitted(counted: DataFrame, labels: DataFrame | None) -> Judge:
    """A judge from a saved table of counts and doc_id.  ``labels`` has doc_id and quality
    (1 good, 0 bad); several labels of an id agree by the lowest."""
    rows = counted.select("doc_id", *COUNTS, *SHAPES).where(~base_failed())
    if labels is None:
        known = rows.withColumn("quality", F.lit(None).cast("int"))
    else:
        quality = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
            F.min("quality").cast("int").alias("quality")
        )
        known = rows.join(quality, "doc_id", "left")
    known = saved(known, "labelled")
    sample = _sample(known.where("quality = 1"))
    if not len(sample):
        sample = _sample(known)
    if not len(sample):
        return Judge(None, 2.0)
    ratios = {
        "n_words": F.lit(1.0),
        "word_chars": F.col("word_chars") / F.col("n_words"),
        "n_symbols": F.col("n_symbols") / F.col("n_words"),
        "n_repeat_words": F.col("n_repeat_words") / F.col("n_words"),
        "n_distinct": F.col("n_distinct") / F.pow(F.col("n_words").cast("double"), F.lit(0.9)),
    }
    ends = known.agg(*[f(c).alias(f"{f.__name__}_{n}") for f in (F.min, F.max) for n, c in ratios.items()]).first()
    low, high = (statistics({n: np.array([ends[f"{f}_{n}"]]) for n in ratios})[0] for f in ("min", "max"))
    judge = Judge(Forest(sample, low, high), 2.0)
    judge.limit = _threshold(_scored(known.where("quality IS NOT NULL"), judge))
    return judge


def _sample(rows: DataFrame) -> np.ndarray:
    """Statistics of about SAMPLE rows, chosen by a hash of the id and the counts."""
    total = rows.count()
    names = [*COUNTS, *SHAPES]
    part = int(min(1.0, SAMPLE / max(total, 1)) * (1 << 30))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", *names), F.lit(1 << 30)) < part).select(*names)
    columns = list(zip(*picked.limit(2 * SAMPLE).collect(), strict=True)) or [()] * len(names)
    table = statistics({n: np.array(c, float) for n, c in zip(names, columns, strict=True)})
    return table[np.lexsort(table.T)]


def _scored(rows: DataFrame, judge: Judge) -> DataFrame:
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(judge)
    schema = T.StructType([*rows.schema.fields, T.StructField("anomaly", T.DoubleType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {n: batch.column(n).to_numpy() for n in (*COUNTS, *SHAPES)}
            yield batch.append_column("anomaly", pa.array(shared.value.scores(counts)))

    return rows.mapInArrow(work, schema)


def judged(documents: DataFrame, labels: DataFrame | None, text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, anomaly and kept of every document."""
    counted = saved(rule_counts(documents, ("doc_id",), text), "rules")
    judge = fitted(counted, labels)
    kept = ~F.col("base_failed") & (F.col("anomaly") < F.lit(judge.limit))
    return _scored(counted, judge).withColumn("base_failed", base_failed()).select(
        "doc_id", *COUNTS, "base_failed", "anomaly", kept.alias("kept")
    )


def filtered(documents: DataFrame, labels: DataFrame | None, text: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns; the texts are counted once more
    in the pass that filters them, which spares shuffling them."""
    judge = fitted(saved(rule_counts(documents, ("doc_id",), text), "rules"), labels)
    shared = documents.sparkSession.sparkContext.broadcast(judge)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SMALL_SLICE):
                yield part.filter(pa.array(shared.value.kept(_counts(part.column(text)))))

    return documents.mapInArrow(work, documents.schema)


def _threshold(scored: DataFrame) -> float:
    """The score from which texts are rejected; 2, beyond every score, where a kind of label
    is missing."""
    binned = (
        scored.where("quality IS NOT NULL")
        .groupBy(F.floor(F.col("anomaly") * SCORE_BINS).alias("bin"), "quality")
        .count()
        .collect()
    )
    above = np.zeros((2, SCORE_BINS + 2))
    for bin_, quality, n in binned:
        above[quality, int(bin_)] += n
    above = np.cumsum(above[:, ::-1], 1)[:, ::-1]
    bad, good = above
    if not good[0] or not bad[0]:
        return 2.0
    lowest = np.flatnonzero(good <= SPARE * good[0])[0]
    highest = np.flatnonzero(bad >= 0.99 * bad[lowest])[-1]
    return float(lowest + max(highest, lowest)) / 2 / SCORE_BINS
