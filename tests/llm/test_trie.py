"""The prefix trie against a trie built node by node."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from kerbcast.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """(conv_id, depth) -> the other columns, from rows of one number a turn."""
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(own, key=lambda x: x[:3])] for c, own in original.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, own in whole.items():
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        worth = (len(own) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += worth
            leaves[p[:d]] += p not in children
    out = {}
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(whole[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out[min(own), len(p)] = (
            parent, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()
        )
    return out


def found(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "role AS key", "turn AS depth", "text AS path", "1 AS n")
    nodes = trie.trie(table).collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in nodes}
    assert len(out) == len(nodes)
    return out


def conversation(rng, conv, n, shared=()):
    texts = [*shared, *(rng.choice(["yes", "no", "", "Straße"]) + str(rng.randint(0, 3)) for _ in range(n))]
    return [(conv, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = []
    opening = ["hello", "hi there", "how", "so"]
    for conv in rng.sample(range(-40, 160), 90):
        rows += conversation(rng, conv, rng.randint(1, 7), opening[: rng.choice([0, 0, 2, 4])])
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_copies_long_conversations_and_truncations(spark):
    rng = random.Random(11)
    rows = []
    # Equal ones, and one cut at every length, under ids whose first turns are their own.
    long = [t for *_, t in conversation(rng, 0, 120)]
    for k in range(60):
        rows += [(5 * k, n, "user", t) for n, t in enumerate(long)]
    for k in range(60, 75):
        rows += [(5 * k, n, "user", t) for n, t in enumerate(long[: k - 55])]
    for k in range(75, 80):
        rows += [(5 * k, n, "user", t) for n, t in enumerate([*long[:100], str(k), "x"])]
    rows += [(5 * k + 1 + k % 4, n, "user", t) for k in range(20) for n, t in enumerate(long[:6])]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 3, None, None), (1, 0, "", ""), (1, 2**40, "user", "late"),
        (2, 0, "user", "a"), (2, 0, "assistant", "a"), (2, 0, "user", "a"), (2, -1, "user", "a"),
        (None, 0, "user", "nobody"), (None, None, None, None),
        # Role and text are kept apart.
        (10, 0, "user", "xy"), (15, 0, "userx", "y"), (20, 0, "user", "xy"), (25, 0, "", "userxy"),
        (7, 0, "user", "only turn"), (30, 0, "user", "é" * 70_000),
    ]
    assert found(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, 1, "user", "x")]) == {}


def test_a_turnless_conversation_ends_at_the_root(spark):
    # crc32 of these ids leaves more first turns to an absent conversation than they have.
    ids = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:6]
    rows = [(c, k, "user", "t") for c in ids for k in range(2)]
    nodes = found(spark, rows)
    assert nodes == brute(rows)
    ends = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert nodes == {(ids[0], 0): (None, 6, 0, 1, 0, ends)}
