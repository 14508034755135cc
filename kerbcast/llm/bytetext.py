"""Whole batches of texts as bytes in numpy: words, lines and their 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD = np.ones(256, bool)
IS_WORD[list(BLANKS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of text handled at once; bounds the memory of a task whatever the rows are.
SLICE_BYTES = 2 << 20
#: The same where tables of words and lines are many times as large as the text.
SMALL_SLICE = 512 << 10


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(seed: int, n: int) -> np.ndarray:
    """n fixed pseudorandom odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + np.uint64(seed)) | np.uint64(1)


BYTE = random_words(11, 256)
#: Weights of the low and the high 16 bits of a place within a run.
PLACE, FAR_PLACE = random_words(23, 1 << 16), random_words(37, 1 << 16)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row runs of about ``limit`` bytes of text; one text is never cut."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes within each text: starts, ends, text number."""
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's bytes; equal bytes give equal hashes anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(firsts, lengths)
    values = BYTE[data[place + np.repeat(starts, lengths)]] * PLACE[place & 0xFFFF]
    if lengths.max() > 1 << 16:
        # Places 65,536 apart weigh differently too; those before weigh what they do in short runs.
        far = np.flatnonzero(place >> 16)
        values[far] *= FAR_PLACE[place[far] >> 16 & 0xFFFF]
    return mixed(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))
