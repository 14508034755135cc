"""Near-duplicate texts and vectors against all pairs compared by brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kerbcast.llm import hashing, minhash
from kerbcast.llm.common import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def joined(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(f"c{k:03}", f"c{k + 1:03}") for k in range(70)]
    star = [("s000", f"t{k:03}") for k in range(50)]
    edges = spark.createDataFrame([*chain, *star, ("z", "z")], "x string, y string")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {x: ("c000" if x[0] == "c" else "s000") for pair in [*chain, *star] for x in pair}


def test_shingles_are_sets_of_words_in_lower_case():
    texts = ["A b c d E f", "a B\tc\n d e F", "a b", "a  b", "b a", None, " ", "É b", "é b"]
    values, at = minhash.shingles(pa.array(texts))
    sets = [set(values[b:e].tolist()) for b, e in zip(at[:-1], at[1:], strict=True)]
    assert [len(s) for s in sets] == [2, 2, 1, 1, 1, 0, 0, 1, 1]
    assert sets[0] == sets[1] and sets[2] == sets[3] != sets[4] and sets[7] != sets[8]


@pytest.mark.parametrize("percent", [85, 80])
def test_documents_match_all_pairs(documents, corpus, percent):
    sets = [shingle_set(t) for _, t in corpus]
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    part = joined(len(sets), links)
    least = {}
    for (doc_id, _), root in zip(corpus, part, strict=True):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, math.inf))
    expected = sorted(
        (str(i), len(s), str(least.get(root, i) if s else i)) for (i, _), s, root in zip(corpus, sets, part, strict=True)
    )
    rows = minhash.linked_components(documents, percent=percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_a_family_around_a_hub_is_one_component_and_bystanders_stay_out(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(60):
        own = list(base)
        for at in rng.sample(range(200), 2 if k % 2 else 12):
            own[at] = f"x{k}_{at}"
        rows.append((k + 1, " ".join(own)))
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(61) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    found = minhash.linked_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["component_id"] for r in sorted(found)] == joined(61, links)


def test_one_document_of_each_group_stays(documents, corpus):
    kept = minhash.deduplicated(documents)
    assert kept.columns == documents.columns
    rows = kept.select("doc_id", "text", "node").collect()
    texts = dict(corpus)
    assert all(r["node"] == f"own {r['doc_id']}" and texts[r["doc_id"]] == r["text"] for r in rows)
    expected = {r["doc_id"] for r in minhash.linked_components(documents).where("kept").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(expected)


def test_no_documents(no_documents):
    assert minhash.linked_components(no_documents).collect() == []
    assert minhash.deduplicated(no_documents).collect() == []


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(120):
        base = rng.standard_normal(24)
        rows.append((base, int(rng.integers(3))))
        for _ in range(rng.integers(4)):
            rows.append((base + rng.standard_normal(24) * rng.uniform(0, 0.5), rows[-1][1]))
    rows += [(rows[0][0], rows[0][1])] * 3 + [(rows[5][0] * 2, rows[5][1]), (rows[5][0], None)]
    rows = [(7 * k, v.astype(np.float32).tolist(), label) for k, (v, label) in enumerate(rows)]
    odd = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] * 24, [1.0, 2.0], [2.0, 4.0]]
    rows += [(-k - 1, v, 1) for k, v in enumerate(odd)] + [(-99, odd[0], None)]
    return [*rows, rows[0]]


def test_vectors_match_all_pairs(spark, vectors):
    frame = spark.createDataFrame([(*r, "own", "own") for r in vectors], "vec_id long, embedding array<float>, label int, node string, vector string")
    usable = [
        v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) and label is not None
        for _, v, label in vectors
    ]
    links, near = [], 0
    for a in range(len(vectors)):
        for b in range(a):
            (_, x, kind), (_, y, other) = vectors[a], vectors[b]
            if usable[a] and usable[b] and kind == other and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                cosine = x @ y / np.linalg.norm(x) / np.linalg.norm(y)
                near += abs(cosine - 0.93) < 1e-9
                if cosine >= 0.93:
                    links.append((a, b))
    assert not near
    part = joined(len(vectors), links)
    count = np.bincount(np.array(links).ravel(), minlength=len(vectors))
    least = {}
    for (i, *_), root in zip(vectors, part, strict=True):
        least[root] = min(i, least.get(root, i))
    found = hashing.linked_vectors(frame).collect()
    assert sum(r["n_links"] for r in found) >= 0.9 * count.sum()
    expected = sorted((i, int(n), least[root], i == least[root]) for (i, *_), n, root in zip(vectors, count, part, strict=True))
    assert sorted(tuple(r) for r in found) == expected


def test_no_usable_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hashing.linked_vectors(spark.createDataFrame([], schema)).collect() == []
    alone = hashing.linked_vectors(spark.createDataFrame([(None, [1.0], None), (2, None, 3)], schema)).collect()
    assert sorted(alone, key=str) == sorted([(None, 0, None, True), (2, 0, 2, True)], key=str)


def pairs_at_limit(n, mean=0.0, width=64, seed=11):
    """``n`` pairs of unit vectors with a cosine of just over 0.93, whose vectors have a mean
    cosine of about ``mean`` with those of other pairs."""
    rng = np.random.default_rng(seed)
    first = rng.standard_normal((n, width))
    first *= math.sqrt(1 - mean) / np.linalg.norm(first, axis=1, keepdims=True)
    first[:, 0] += math.sqrt(mean)
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    second, _ = hashing.at_limit(first, hashing.COSINE + 1e-9, seed + 1)
    return first, second


@pytest.mark.parametrize("part", [4, 8, 12, 16, 20])
@pytest.mark.parametrize("mean", [0.0, 0.5, 0.7, 0.8])
def test_pairs_at_the_limit_meet_whatever_their_mean_and_the_length_of_a_part(mean, part):
    first, second = pairs_at_limit(2000, mean)
    sample = np.vstack([first, second])[::2]
    shares = hashing.Rotations(sample, codes=hashing.MEASURED).shares(sample)
    tables = hashing.n_tables(part, shares)
    rotations = hashing.Rotations(sample, codes=hashing.n_codes(part, tables))
    a, b = rotations.bits(first), rotations.bits(second)
    differ = np.bitwise_count(hashing.parts(a, part, tables) ^ hashing.parts(b, part, tables))
    far = (a != b)[:, : 64 * hashing.CODES].sum(1) > hashing.bits_apart(shares)
    assert ((differ.min(1) <= 1) & ~far).mean() >= 0.998


def links_by_all_pairs(rows):
    rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return int((np.triu(rows @ rows.T, 1) >= hashing.COSINE).sum())


def links_found(spark, rows, **options):
    frame = spark.createDataFrame(
        [(k, v.tolist(), 1) for k, v in enumerate(rows)], "vec_id long, embedding array<double>, label int"
    )
    return sum(r["n_links"] for r in hashing.linked_vectors(frame, **options).collect()) / 2


def test_long_parts_lose_no_links(spark):
    rows = np.vstack(pairs_at_limit(300))
    assert links_by_all_pairs(rows) == 300 == links_found(spark, rows, part=25)


@pytest.mark.parametrize("mean", [0.5, 0.8])
def test_vectors_with_a_common_mean_lose_no_links(spark, mean):
    rows = np.vstack(pairs_at_limit(1500, mean))
    links = links_by_all_pairs(rows)
    assert links >= 1500
    assert links_found(spark, rows) >= 0.999 * links


def test_vectors_that_nearly_all_link_meet(spark, monkeypatch):
    monkeypatch.setattr(hashing, "SLICE", 16)  # buckets in several slices
    rng = np.random.default_rng(2)
    rows = np.eye(1, 16) * 8 + rng.standard_normal((300, 16)) * 0.5
    links = links_by_all_pairs(rows)
    assert links > 0.7 * 300 * 299 / 2
    assert links_found(spark, rows) >= 0.999 * links


def test_a_plan_has_longer_parts_for_more_vectors_and_more_tables_for_wider_angles():
    near, far = np.full((2, 64), 0.12), np.full((2, 64), 0.27)
    lengths = [hashing.plan(size, near)[0] for size in (10**3, 10**5, 10**7)]
    assert lengths == sorted(set(lengths))
    assert hashing.plan(10**5, far)[1] > hashing.plan(10**5, near)[1]
    assert hashing.plan(10**5, np.full((2, 64), 0.5))[0] <= 2
    assert hashing.plan(10**5, np.zeros((2, 64)))[1] == 1
