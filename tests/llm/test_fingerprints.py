"""Fingerprints against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from kerbcast.llm import prefixes
from kerbcast.llm.prefixes import Fingerprint, Prefixes, edited, fingerprints, likeness
from tests.llm.conftest import words


def prose(rng, n):
    return " ".join(words(rng, n))


def test_spans_are_equal_where_code_points_are_and_only_there():
    rng = random.Random(3)
    a = "".join(rng.choice("ab\U0001f600\x00é") for _ in range(400))
    b = "".join(rng.choice("ab\U0001f600\x00é") for _ in range(200)) + a[50:300]
    x, y = (Prefixes(prefixes.code_points([t])[0]) for t in (a, b))
    for _ in range(3000):
        i, j, n = rng.randrange(300), rng.randrange(300), rng.randrange(12)
        assert (x.span(i, i + n) == y.span(j, j + n)) == (a[i : i + n] == b[j : j + n])


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_longest_extensions_match_a_plain_search(letters):
    rng = random.Random(len(letters))
    a = "".join(rng.choice(letters) for _ in range(300))
    b = a[:100] + "#" + a[90:]
    x, y = (Prefixes(prefixes.code_points([t])[0]) for t in (a, b))
    for _ in range(500):
        i, j = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert x.extension(i, y, j) == n


def test_fingerprints_do_not_depend_on_the_texts_beside_them_and_are_read_back():
    rng = random.Random(5)
    texts = [prose(rng, n) for n in (0, 1, 2, 5, 40, 300, 2000)] + ["", "x", "ab" * 4000, "z" * 100]
    together = fingerprints(texts)
    assert [fingerprints([t])[0] for t in texts] == together
    assert [Fingerprint.read(p.written()) for p in together] == together
    assert all(len(p.places) <= prefixes.ANCHORS + 16 for p in together)
    assert len({p.written() for p in together}) == len(set(texts))


def test_likeness_follows_what_texts_share():
    rng = random.Random(9)
    base = prose(rng, 400)
    print_ = lambda t: fingerprints([t])[0]
    near = lambda a, b: likeness(print_(a), print_(b))
    assert near(base, base) == 1.0 and near("", "") == 1.0 and near("", "a") == 0.0
    third = len(base) // 3
    other = prose(rng, 400)
    assert near(base, other) < 0.05
    assert abs(near(base, edited(base, other)) - 2 / 3) < 0.1
    # A moved passage, an insertion at the start, a word changed in the middle, a half.
    assert near(base, base[third:] + base[:third]) > 0.85
    assert near(base, "in front " + base) > 0.9
    assert near(base, base[: len(base) // 2] + "#" + base[len(base) // 2 + 1 :]) > 0.9
    half = base[: len(base) // 2]
    assert abs(near(base, half) - 2 * len(half) / (len(base) + len(half))) < 0.12
    # Symmetric, whatever the lengths.
    for a, b in ((base, half), (half, other + half), ("abc", "abd"), ("a" * 500, "a" * 300)):
        assert near(a, b) == near(b, a)
    assert near("abcdefghij", "abcdefgxyz") == 0.7
    assert near("Of " * 500, edited("Of " * 500, other)) > 0.55


def test_documents_match_plain_python(documents, corpus):
    rows = [(i, t or "") for i, t in corpus]
    found = prefixes.fingerprinted(documents).collect()
    assert len(found) == len(rows)
    # Repeated ids are ordered by a hash; what follows them is left out of the comparison.
    single = [i for i, _ in rows if i is not None and sum(j == i for j, _ in rows) == 1]
    text = dict(rows)
    by_id = {r["doc_id"]: r for r in found}
    checked = 0
    for at, i in enumerate(sorted(single, reverse=True)[:-1]):
        after = sorted(single, reverse=True)[at + 1]
        if any(after < j < i for j, _ in rows if j is not None):
            continue
        a, b = text[i], text[after]
        cut = len(a) // 3
        changed = a[: len(a) - cut] + b[:cut]
        r = by_id[i]
        assert r["n_chars"] == len(a)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        prints = fingerprints([a, changed, b])
        assert r["fingerprint"] == prints[0].written()
        assert r["edited_fingerprint"] == prints[1].written()
        assert r["near_edited"] == likeness(prints[0], prints[1])
        assert r["near_next"] == likeness(prints[0], prints[2])
        checked += 1
    assert checked > 80
    written = {}
    for i, t in rows:
        written.setdefault(t, set()).add(fingerprints([t])[0].written())
    assert all(len(v) == 1 for v in written.values())


def test_order_holds_over_any_number_of_partitions(spark, corpus):
    rows = [(k, t) for k, (_, t) in enumerate(corpus)]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {}
    for at, (i, t) in enumerate(rows):
        expected[i] = hashlib.sha256(edited(t or "", rows[at - 1][1] or "").encode()).hexdigest()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found = prefixes.fingerprinted(whole.repartition(5)).collect()
            assert {r["doc_id"]: r["edited_sha256"] for r in found} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_row_and_no_row(spark, no_documents):
    assert prefixes.fingerprinted(no_documents).collect() == []
    one = spark.createDataFrame([(None, None)], "doc_id long, text string")
    row = prefixes.fingerprinted(one).first()
    assert (row["doc_id"], row["n_chars"], row["near_edited"], row["near_next"]) == (None, 0, 1.0, 1.0)
    assert row["edited_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_long_text(spark):
    long = "wörd \n" * 60_000 + "end"
    rows = spark.createDataFrame([(2, long), (1, "short")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in prefixes.fingerprinted(rows).collect()}
    assert found[2]["n_chars"] == len(long) and np.isclose(found[2]["near_edited"], 0.8, atol=0.05)
    assert found[2]["edited_sha256"] == hashlib.sha256((long[: len(long) - len(long) // 3] + "short").encode()).hexdigest()
