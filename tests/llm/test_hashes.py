"""Hashes of long runs follow every byte's place."""

import numpy as np
import pyarrow as pa
import pytest

from kerbcast.llm import minhash, rules
from kerbcast.llm.bytetext import run_hashes


def hashes(runs):
    data = np.frombuffer(b"".join(runs), np.uint8)
    ends = np.cumsum([len(r) for r in runs])
    return run_hashes(data, ends - [len(r) for r in runs], ends).tolist()


@pytest.mark.parametrize("length", [65_535, 65_536, 65_537, 131_073, 200_000])
def test_exchanged_bytes_change_the_hash_at_any_distance(length):
    rng = np.random.default_rng(length)
    base = rng.integers(97, 123, length).astype(np.uint8)
    base[0], base[-1] = 1, 2
    runs = [base.tobytes(), base.tobytes(), base[:-1].tobytes()]
    for apart in (1, 255, 65_535, 65_536, 65_537, 131_072):
        if apart < length:
            other = base.copy()
            other[0], other[apart] = (9, 1)
            swapped = base.copy()
            swapped[0], swapped[apart] = other[apart], other[0]
            third = base.copy()
            third[0], third[apart] = 1, 9
            runs += [other.tobytes(), swapped.tobytes(), third.tobytes()]
    found = hashes(runs)
    assert (found[0] == found[1]) and len(set(found)) == len(set(runs))


def test_long_lines_and_words_are_told_apart(spark):
    word = "a" + "x" * 65_535 + "b" + "y" * 100_000
    other = "b" + "x" * 65_535 + "a" + "y" * 100_000
    values, at = minhash.shingles(pa.array([word, other, word]))
    sets = [set(values[b:e].tolist()) for b, e in zip(at[:-1], at[1:], strict=True)]
    assert sets[0] == sets[2] != sets[1]
    docs = spark.createDataFrame([(1, word), (2, other), (3, word), (4, f"{word}\n{other}\n{word}")], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.linked_components(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1, 4: 4}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    counts = {r["doc_id"]: r["n_dup_lines"] for r in rules.judged(docs, labels).collect()}
    assert counts == {1: 0, 2: 0, 3: 0, 4: 1}
