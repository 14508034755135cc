"""Quality scores by the votes of labelled neighbours in a latent-semantic space.

A text is counted by hashed byte trigrams (letters in lower case, runs of digits as one) and
by two signs in bins of their own: a word equal to the one before it, and a capital after a
capital.  Counts are weighted by how rare they are, and projected to ``RANK`` latent dimensions.  The
projection, and the labelled vectors that vote, come from a bounded sample: at most
``SAMPLE`` labelled rows of each kind, those with the smallest hash of their id.  Vectors and
projection have a fixed size and are broadcast.  Every document is compared with all of them, a
block at a time, by exact cosines; the ``NEIGHBOURS`` nearest vote with the weight of their
similarity, and with the weight of their kind, so that the sample's balance does not count.

Results for odd rows: a text without trigrams (null, empty, under three bytes) is like
nothing and gets the share of good labels; several labels of an id agree by the lowest; a
null id is scored and is not held out; repeated rows get equal scores; without labels of both
kinds every score is that share, or a half without labels; an empty table gives an empty
table.  Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbcast.llm.bytetext import IS_WORD, LOWER, flat, mixed, run_hashes, runs, slices
from kerbcast.llm.common import saved, ship

#: Rows of each label that the vectors are taken from, at most.
SAMPLE = 2048
BINS, RANK, NEIGHBOURS, BLOCK = 4096, 48, 15, 256
#: Steps of a unit: sums over all BINS of counts times projection stay below 2**53.
COUNT_STEPS, PROJECTION_STEPS, VECTOR_STEPS = 1 << 12, 1 << 18, 1 << 20
#: Bins that each sign fills, so that it counts beside the many trigrams.
SIGN = 8
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Rows of BINS counts."""
    data, offsets = flat(texts)
    n = len(texts)
    if not len(data):
        return np.zeros((n, BINS), np.float32)
    of = np.repeat(np.arange(n), np.diff(offsets))
    starts, ends, word_of = runs(IS_WORD[data], offsets)
    words = run_hashes(data, starts, ends)
    repeats = word_of[1:][(words[1:] == words[:-1]) & (word_of[1:] == word_of[:-1])]
    capital = (data >= 65) & (data <= 90)
    shouts = of[1:][capital[1:] & capital[:-1] & (of[1:] == of[:-1])]
    data = LOWER[data]
    digit = _DIGIT[data]
    again = np.zeros(len(data), bool)
    again[1:] = digit[1:] & digit[:-1] & (of[1:] == of[:-1])
    data = np.where(digit, np.uint8(48), data)[~again].astype(np.uint64)
    of = of[~again]
    if len(data) < 3:
        return np.zeros((n, BINS), np.float32)
    bins = mixed(data[:-2] << np.uint64(16) | data[1:-1] << np.uint64(8) | data[2:]) % np.uint64(BINS - 2 * SIGN)
    inside = of[2:] == of[:-2]
    keys = of[2:][inside] * BINS + bins[inside].astype(np.int64)
    table = np.bincount(keys, minlength=n * BINS).reshape(n, BINS).astype(np.float32)
    table[:, -2 * SIGN : -SIGN] = np.bincount(repeats, minlength=n)[:, None]
    table[:, -SIGN:] = np.bincount(shouts, minlength=n)[:, None]
    return table


class Voters:
    """The projection, the labelled vectors and their votes.

    Weighted counts, projection and vectors are whole numbers of small steps, whose products
    and sums are exact in double precision: a text's score does not depend on the texts that
    share its block, nor on the block's size.
    """

    def __init__(self, counts: np.ndarray, quality: np.ndarray, share: float) -> None:
        self.share = share
        self.weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
        table = np.log1p(counts) * self.weights
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
        rng = np.random.default_rng(9)
        basis = rng.standard_normal((BINS, RANK + 16)).astype(np.float32)
        for _ in range(4):  # subspace iteration towards the leading right singular vectors
            basis = np.linalg.qr(table.T @ (table @ basis))[0]
        small = np.linalg.svd(table @ basis, full_matrices=False)[2]
        self.projection = np.rint((basis @ small[:RANK].T).astype(float) * PROJECTION_STEPS)
        self.vectors = self.placed(counts).T.copy()
        kinds = np.array([np.mean(quality == 0), np.mean(quality == 1)])
        self.votes = (np.array([1 - share, share]) / kinds)[quality]
        self.good = self.votes * quality

    def placed(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space, in steps; zeros where there are no counts."""
        table = np.rint(np.log1p(counts, dtype=float) * self.weights * COUNT_STEPS) @ self.projection
        norms = np.sqrt((table * table).sum(1, keepdims=True))
        return np.rint(table / np.where(norms > 0, norms, 1) * VECTOR_STEPS)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.share)
        for begin in range(0, len(counts), BLOCK):
            block = counts[begin : begin + BLOCK]
            products = self.placed(block) @ self.vectors
            n = products.shape[1]
            k = min(NEIGHBOURS, n)
            # Of equal cosines the earlier voter's counts as the nearer.
            ranked = products.astype(np.int64) * n - np.arange(n)
            nearest = np.sort(np.argpartition(ranked, -k, axis=1)[:, -k:], axis=1)
            near = np.maximum(np.take_along_axis(products, nearest, 1) / VECTOR_STEPS**2, 0) ** 4
            total = (near * self.votes[nearest]).sum(1)
            full = total > 1e-12
            good = (near * self.good[nearest]).sum(1)
            out[begin : begin + BLOCK][full] = good[full] / total[full]
        return np.clip(out, 0.0, 1.0)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(documents: DataFrame, labels: DataFrame, text: str = "text") -> Voters | float:
    """Voters, or the share of good labels where there are not both kinds."""
    known = saved(
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality")),
        "known",
    )
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    if len(totals) < 2:
        return share
    chosen = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for q in (0, 1)
    ]
    # At most twice SAMPLE ids: a broadcast of bounded size.
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))
    ship(documents.sparkSession)
    texts = documents.select("doc_id", documents[text].alias("__text")).join(picked, "doc_id")
    names = ["doc_id", "quality", "bins", "counts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                for begin in range(0, part.num_rows, BLOCK):
                    rows = part.slice(begin, BLOCK)
                    counts = trigram_counts(rows.column("__text"))
                    bins = [np.flatnonzero(c).astype(np.int32) for c in counts]
                    held = [c[b].astype(np.int32) for c, b in zip(counts, bins, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("doc_id").cast(pa.int64()),
                            rows.column("quality").cast(pa.int32()),
                            pa.array(bins, pa.list_(pa.int32())),
                            pa.array(held, pa.list_(pa.int32())),
                        ],
                        names=names,
                    )

    # One text for each id, so that the bound on ids bounds what the driver reads.
    schema = "doc_id long, quality int, bins array<int>, counts array<int>"
    one = texts.mapInArrow(work, schema).groupBy("doc_id").agg(F.min(F.struct("bins", "counts", "quality")).alias("r"))
    rows = one.orderBy("doc_id").select("r.*").collect()
    counts = np.zeros((len(rows), BINS), np.float32)
    for k, row in enumerate(rows):
        counts[k, row["bins"]] = row["counts"]
    quality = np.array([r["quality"] for r in rows], np.int64)
    full = counts.any(1)
    counts, quality = counts[full], quality[full]
    return Voters(counts, quality, share) if len(set(quality.tolist())) == 2 else share


def scored(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    voters = fitted(documents, labels, text)
    shared = documents.sparkSession.sparkContext.broadcast(voters)
    schema = T.StructType([documents.schema["doc_id"], T.StructField("score", T.DoubleType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = shared.value
        for batch in batches:
            for part in slices(batch, "__text", 1 << 19):
                for begin in range(0, part.num_rows, BLOCK):
                    rows = part.slice(begin, BLOCK)
                    if isinstance(voters, float):
                        scores = np.full(rows.num_rows, voters)
                    else:
                        scores = voters.score(trigram_counts(rows.column("__text")))
                    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    ship(documents.sparkSession)
    rows = documents.select("doc_id", documents[text].alias("__text")).mapInArrow(work, schema)
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
