"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The singular vectors of the centred rows X are the components, its singular values over
sqrt(n) their deviations.  Each step is one scan: tasks multiply their blocks of centred rows
by the current right vector v, giving their share of w = Xv, and at once by the transpose,
giving a sum of X'w; a task hands on one number for each of the d + k + 1 sums, which Spark
adds up.  The driver holds only d x k numbers: right vectors V, X'U, and the small matrix
U'XV, bidiagonal but for restarts, whose SVD yields components and deviations.

The left vectors u are never stored: each is X times a vector of d numbers, so all that a lost
executor takes with it is its share of one scan.  Both sides are reorthogonalised in full:
V on the driver, U by the sums U'w of the same scan, with a second scan where the first took
away much (``AGAIN``).  A step that meets an exhausted space starts from a new direction.  Up to
``FULL`` dimensions are always bidiagonalised in full; wider spaces stop once the wanted
vectors have settled to rounding.

Results for odd rows: a vector that is null, or holds a null, NaN or infinite entry, is
dropped; one shorter than the longest counts as zero beyond its end; entries beyond 2^30
count as that; squared deviations beyond 64 bits are null; repeated rows and null ids are rows
of their own; directions without variance (deviations below ``FLAT`` of the largest) are no
components, so equal vectors or a single one give no rows; an empty table gives an empty table.  Extra columns of any name are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import saved, ship

#: Components, rows of a block, and dimensions that are always bidiagonalised in full.
COMPONENTS, BLOCK, FULL = 8, 4096, 64
#: Residual at which a vector has settled, share of a vector that makes a second
#: orthogonalisation needed, deviations that count as none: all relative.
SETTLED, AGAIN, FLAT = 1e-15, 0.7, 1e-9


def usable(vector: Column) -> Column:
    """The vector is there and all its entries are finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches in blocks of rows, with their vectors as a table; short ones end in zeros."""
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(begin, BLOCK)
            vectors = rows.column("vector")
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            table = np.zeros((rows.num_rows, width), flat.dtype)
            table[np.arange(width) < lengths[:, None]] = flat
            yield rows, table


def summed(rows: DataFrame, width: int, share: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``share`` (a row of numbers for a block of vectors) over all blocks.  A task
    hands on one number a place; Spark adds them, so the driver gets one number a place
    however many tasks there are."""
    ship(rows.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, table in _blocks(batches, width):
            part = share(table)
            total = part if total is None else total + part
        if total is not None:
            place = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([place, pa.array(total)], names=["place", "value"])

    parts = rows.select("vector").mapInArrow(work, f"place int, value {kind}")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([r["value"] for r in sorted(found, key=lambda r: r["place"])])


@dataclass(frozen=True)
class Centre:
    """n rows and the totals of each dimension; whole numbers stay exact."""

    n: int
    totals: np.ndarray

    def of(self, table: np.ndarray) -> np.ndarray:
        """Rows minus totals / n.  Whole numbers lose the whole part of the mean first, so
        nothing is rounded before the fraction."""
        if self.totals.dtype.kind != "i":
            return table - self.totals / self.n
        whole, rest = np.divmod(self.totals, self.n)
        return (table - whole) - rest / self.n


@dataclass(frozen=True)
class Whitening:
    """Unit components (columns), the deviation along each, and the variance of all."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    variance: float

    @property
    def width(self) -> int:
        return len(self.centre.totals)

    def apply(self, table: np.ndarray) -> np.ndarray:
        return self.centre.of(table) @ self.components / self.deviations

    @property
    def explained(self) -> np.ndarray:
        return self.deviations**2 / self.variance

    def identity_error(self, rows: DataFrame) -> float:
        """The largest entry of the whitened rows' covariance minus the identity."""
        k = len(self.deviations)
        apply = self.apply

        def share(table: np.ndarray) -> np.ndarray:
            values = apply(table)
            return np.concatenate([values.sum(0), (values.T @ values).ravel()])

        sums = summed(rows, self.width, share) / self.centre.n
        return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def _scan(rows: DataFrame, centre: Centre, left: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(U'w, X'w, w'w) for w = X step and U = X left, in one scan of the rows."""
    width, k = left.shape

    def share(table: np.ndarray) -> np.ndarray:
        x = centre.of(table)
        w = x @ step
        return np.concatenate([(x @ left).T @ w, x.T @ w, [w @ w]])

    sums = summed(rows, width, share)
    return sums[:k], sums[k:-1], float(sums[-1])


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalised(rows: DataFrame, centre: Centre, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors (columns) and singular values of the centred rows."""
    width = len(centre.totals)
    rng = np.random.default_rng(seed)
    right = np.zeros((width, 0))
    left = np.zeros((width, 0))  # left vectors as X times these
    back = np.zeros((width, 0))  # X'u of each left vector
    following, beta, scale = None, 0.0, 0.0
    while right.shape[1] < width:
        if following is None:
            fresh = _orthogonal(rng.standard_normal(width), right)
            following, beta = fresh / np.linalg.norm(fresh), 0.0
        v, following = following, None
        # w = Xv - beta u, then freed of all left vectors.
        step = v - beta * left[:, -1] if beta else v
        length = None
        while True:
            along, product, squared = _scan(rows, centre, left, step)
            before = np.sqrt(squared)
            step = step - left @ along
            product = product - back @ along
            length = np.sqrt(max(squared - along @ along, 0.0))
            scale = max(scale, before)
            if length >= AGAIN * before or length <= FLAT * scale * 1e-3:
                break
        exhausted = length <= FLAT * scale * 1e-3
        right = np.column_stack([right, v])
        left = np.column_stack([left, np.zeros(width) if exhausted else step / length])
        back = np.column_stack([back, np.zeros(width) if exhausted else product / length])
        if exhausted:
            continue
        rest = _orthogonal(back[:, -1], right)
        beta = float(np.linalg.norm(rest))
        if beta > 1e-13 * scale:
            following = rest / beta
        if right.shape[1] >= min(width, max(FULL, wanted)):
            turn, values, _ = np.linalg.svd(back.T @ right)
            off = np.abs(beta * turn[-1, :wanted])
            if off.max() <= SETTLED * values[0]:
                break
    _, values, vectors = np.linalg.svd(back.T @ right)
    return (right @ vectors.T)[:, :wanted], values[:wanted]


def fit(rows: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (vector: arrays of longs or doubles, all usable); None if
    there are no rows or no entries."""
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not sizes["n"] or not sizes["width"]:
        return None
    kind = rows.schema["vector"].dataType.elementType.simpleString()
    totals = summed(rows, sizes["width"], lambda table: table.sum(0), kind)
    centre = Centre(sizes["n"], totals)
    components, values = bidiagonalised(rows, centre, wanted)
    kept = values > max(FLAT * values[0], 0.0)
    variance = summed(rows, sizes["width"], lambda table: np.array([np.square(centre.of(table)).sum()]))[0]
    return Whitening(centre, components[:, kept], values[kept] / np.sqrt(centre.n), float(variance) / centre.n)


def _squared_deviations(table: np.ndarray, centre: Centre) -> list[int | None]:
    """The sum over dimensions of (n x - totals) squared, exact; null beyond 64 bits."""
    totals, n = centre.totals, centre.n
    bound = float(n) * float(np.abs(table).max(initial=0)) + float(np.abs(totals).max(initial=0))
    if bound < 2.0**62:
        away = n * table - totals
        rough = np.square(away.astype(float)).sum(1)
        if rough.max(initial=0.0) < 2.0**62:
            return np.square(away).sum(1).tolist()
    exact = [sum((n * int(x) - int(s)) ** 2 for x, s in zip(row, totals, strict=True)) for row in table]
    return [value if value < 2**63 else None for value in exact]


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whitened(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component, over vectors in whole steps of 1/1024."""
    spark = embeddings.sparkSession
    vector = F.col("embedding").cast("array<double>")
    found = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    found = found.where(usable(F.col("vector")))
    width = found.agg(F.max(F.size("vector"))).first()[0] or 0
    padded = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector")))
    clipped = lambda c: F.greatest(F.least(F.floor(c * 1024), F.lit(2**40)), F.lit(-(2**40)))
    steps = F.transform(padded, lambda c: clipped(c) + 100000)
    rows = saved(found.select("vec_id", steps.alias("vector")), "steps")
    model = fit(rows, wanted)
    if model is None or not len(model.deviations):
        return spark.createDataFrame([], SCHEMA)
    error = model.identity_error(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.deviations)
        for block, table in _blocks(batches, model.width):
            repeated = np.repeat(np.arange(len(table)), k)
            count = len(repeated)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("vec_id").take(pa.array(repeated)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(table))),
                    pa.array(np.full(count, model.centre.n, np.int64)),
                    pa.array(_squared_deviations(table, model.centre), pa.int64()).take(pa.array(repeated)),
                    pa.array(model.apply(table).ravel()),
                    pa.array(np.tile(model.explained, len(table))),
                    pa.array(np.full(count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(work, SCHEMA)
