"""Operators over the whole corpus, and the pipeline."""

import collections
import hashlib
import itertools
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbcast.llm import mixing, rollup, suffixes
from kerbcast.llm.common import saved, shared_path, staged

WORD = r"[^\x20\x09-\x0D]+"


# Repeated byte strings


def covered(texts):
    """For each text the bytes under a 200-byte string that starts elsewhere too."""
    starts = collections.Counter(t[p : p + 200] for t in texts for p in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 199):
            if starts[t[p : p + 200]] > 1:
                gone[p : p + 200] = True
        out.append(gone)
    return out


def check_removed(frame, rows):
    raw = [(t or "").encode() for _, t in rows]
    expected = []
    for (doc_id, _), t, gone in zip(rows, raw, covered(raw), strict=True):
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        expected.append((doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffixes.repeats_removed(frame).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_repeats_equal_brute_force(documents, corpus):
    check_removed(documents, corpus)


def test_crowded_grams_give_the_same(documents, corpus, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", 3)
    check_removed(documents, corpus)


def test_crowded_grams_meet_in_counts_not_in_joins(documents, corpus, monkeypatch):
    """What many documents share is told by counts, so no row of a join stands for it."""
    plans, saved = [], suffixes.saved
    monkeypatch.setattr(suffixes, "CROWD", 3)
    monkeypatch.setattr(
        suffixes, "saved", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), saved(df, name))[1]
    )
    check_removed(documents, corpus)
    assert not [line for plan in plans for line in plan.split("\n") if "Join" in line and "whole" in line]


def test_a_settled_stretch_is_not_cut_again(spark, monkeypatch):
    """Each distance of a context is answered once, and one context stands for all that share
    an answer, so the rows follow the edges of what is shared."""
    rng = random.Random(4)
    source = "".join(rng.choice("abcdefgh ") for _ in range(700))
    rows = []
    for k in range(40):
        at = rng.randrange(700)
        rows.append((k, f"{k:04d}" * 60 + source[:at] + "#" + f"{k:03d}" + source[at:]))
    tables, saved = {}, suffixes.saved

    def kept(df, name):
        table = saved(df, name)
        if name in ("stretches", "settled"):
            tables.setdefault(name, []).append([r.asDict(True) for r in table.collect()])
        return table

    monkeypatch.setattr(suffixes, "CROWD", 3)
    monkeypatch.setattr(suffixes, "saved", kept)
    check_removed(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    told = collections.Counter(
        (r["context"], d) for step in tables["settled"] for r in step for s in r["spans"] for d in range(s["low"], s["high"] + 1)
    )
    assert told and max(told.values()) == 1
    for before, step in itertools.pairwise(tables["stretches"]):
        wholes = collections.Counter(r["whole"] for r in before if r["whole"] is not None)
        shared = {(r["context"], d) for r in before if wholes[r["whole"]] > 1 for d in range(r["low"], r["high"] + 1)}
        again = sum((r["context"], r["low"]) in shared for r in step)
        width = step[0]["high"] - step[0]["low"] + 1 if step else 1
        longer = before[0]["high"] - before[0]["low"] + 1
        assert again <= sum(n > 1 for n in wholes.values()) * (longer // width)


def test_random_pieces_of_a_common_source(spark):
    rng = random.Random(1)
    source = "".join(rng.choice("abcd ") for _ in range(3000))
    rows = []
    for k in range(60):
        text = ""
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 2900)
            text += source[a : a + rng.choice([150, 199, 200, 201, 260, 500])] + rng.choice(["", "é", "#" * rng.randint(1, 300)])
        rows.append((k, text))
    check_removed(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_no_documents_to_cut(no_documents):
    assert suffixes.repeats_removed(no_documents).collect() == []


def test_deep_shallow_order():
    rng = random.Random(2)
    strings = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)}
    strings |= {b"x" * rng.randint(90, 300) + bytes(rng.choice(b"yz") for _ in range(4)) for _ in range(300)}
    strings |= {b"q" * k for k in range(200)}
    assert suffixes.deep_shallow(list(strings)) == sorted(strings)
    assert suffixes.blind_trie(sorted(strings, key=hash)) == sorted(strings)
    for a, b in zip(list(strings)[:300], list(strings)[1:], strict=False):
        n = suffixes.common(a, b)
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


# Mixing


def filled(sizes, weights, most=3):
    """Targets by sharing again and again until none is above its limit."""
    targets, open_, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_ and rest > 1e-9:
        level = rest / sum(weights[k] for k in open_)
        over = {k for k in open_ if level * weights[k] > most * sizes[k]}
        for k in over or open_:
            targets[k] = most * sizes[k] if over else level * weights[k]
        if not over:
            break
        rest -= sum(targets[k] for k in over)
        open_ -= over
    return targets


def test_targets_and_taken(spark):
    rng = random.Random(4)
    rows = []
    for k in range(900):
        source = rng.choice(["a", "b", "c", "d", "é", None, "tiny" if k < 60 else "a"])
        text = None if k % 50 == 0 else " ".join("w" for _ in range(rng.randint(0, 3 if source == "tiny" else 400)))
        rows.append((k, text, source))
    rows.append((5000, " ".join("v" for _ in range(30000)), "b"))
    frame = spark.createDataFrame([(*r, "own", "own") for r in rows], "doc_id long, text string, source string, size string, place string")
    got = {r["doc_id"]: r for r in mixing.mixed(frame).collect()}
    again = {r["doc_id"]: r for r in mixing.mixed(frame.repartition(7)).collect()}
    assert got == again
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(WORD, text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = dict(zip(order, filled([sizes[s] for s in order], [[5, 2, 1][k % 3] for k in range(len(order))]), strict=True))
    taken = collections.Counter()
    for k, text, source in rows:
        r = got[k]
        assert r["size"] == len(re.findall(WORD, text or "")) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source in order:
        assert abs(taken[source] - targets[source]) <= max(0.03 * targets[source], 64)


def test_permutations_hit_every_index_once(spark):
    for n in (1, 2, 7, 100, 1001):
        frame = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit(n)).alias("p"))
        assert sorted(r["p"] for r in frame.collect()) == list(range(n))


def test_mixed_texts_hold_the_taken_words(documents, no_documents):
    taken = collections.Counter()
    for r in mixing.mixed(documents).collect():
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mixed_texts(documents)
    assert out.columns == documents.columns
    held, texts = collections.Counter(), {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in out.collect():
        found = re.findall(WORD, r["text"])
        assert r["n_chars"] == len(r["text"])
        assert r["node"] == (None if r["doc_id"] is None else f"own {r['doc_id']}")
        whole = iter(re.findall(WORD, texts[r["doc_id"]]))
        assert all(w in whole for w in found)  # in their order
        held[r["doc_id"]] += len(found)
    assert +held == +taken
    assert mixing.mixed_texts(no_documents).collect() == [] == mixing.mixed(no_documents).collect()


# Token totals


def test_batches_count_once(spark):
    counts = spark.createDataFrame(
        [("a", "en", "v1", 5, 4), ("a", "en", "v1", 7, 7), (None, "fr", "v1", None, 3), ("b", None, "v2", 2, 2)],
        "source string, lang string, version string, tokens long, revised long",
    )
    root = shared_path(spark, "test-rollup")
    totals = rollup.TokenRollup(spark, root)
    assert totals.totals().collect() == []
    assert totals.commit("load", rollup.inserts(counts))
    assert not totals.commit("load", rollup.inserts(counts))
    assert not rollup.TokenRollup(spark, root).commit("load", rollup.deletes(counts))
    assert totals.commit("odd/name ~ü", rollup.revisions(counts.where("source IS NULL OR source = 'a'")))
    assert totals.commit("empty", rollup.inserts(counts.limit(0)))
    got = {tuple(r) for r in totals.totals().collect()}
    assert got == {("a", "en", "v1", 2, 11), (None, "fr", "v1", 1, 3), ("b", None, "v2", 1, 2)}
    assert totals.commit("gone", rollup.deletes(counts.where("source = 'b'")))
    assert {tuple(r) for r in totals.totals().collect()} == {("a", "en", "v1", 2, 11), (None, "fr", "v1", 1, 3)}


def test_an_attempt_that_broke_off_does_not_count(spark):
    root = shared_path(spark, "test-rollup")
    totals = rollup.TokenRollup(spark, root)
    counts = spark.createDataFrame([("a", "en", "v", 5)], "source string, lang string, version string, tokens long")
    rollup.inserts(counts).write.parquet(f"{root}/deltas/left-behind")
    assert totals.totals().collect() == []
    assert totals.commit("load", rollup.inserts(counts))
    assert [tuple(r) for r in totals.totals().collect()] == [("a", "en", "v", 1, 5)]


# Pipeline


def test_stages_keep_their_promises(spark, documents, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == documents.columns, name
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    kept = docs.select("doc_id", "text").collect()
    assert kept and all(len(re.findall(WORD, r["text"])) for r in kept)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == len(kept)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: (str(r["doc_id"]), r["ids"])
    assert sorted(whole.collect(), key=key) == sorted(last.collect(), key=key)


def test_an_empty_corpus(spark, no_documents, labels, tmp_path):
    no_documents.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_a_stage_removes_what_the_stage_before_left_unless_it_is_read(spark, tmp_path):
    made = []

    @staged
    def stage(spark, docs):
        made.append(saved(docs.selectExpr("id + 1 AS id"), "kept"))
        made.append(saved(docs, "beside"))
        return made[-2]

    def there():
        return [Path(t._kerbcast_path).exists() for t in made]

    outside = saved(spark.range(3), "outside")
    lazy = stage(spark, stage(spark, spark.range(5)))
    assert there() == [True, False, True, True]
    assert sorted(r["id"] for r in lazy.collect()) == [2, 3, 4, 5, 6]
    lazy.write.parquet(str(tmp_path / "out"))
    last = stage(spark, spark.read.parquet(str(tmp_path / "out")))
    assert there() == [False, False, False, False, True, True]
    assert sorted(r["id"] for r in last.collect()) == [3, 4, 5, 6, 7]
    assert outside.count() == 3
