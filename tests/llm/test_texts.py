"""Operators on single texts against plain versions."""

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbcast.llm import chat, neighbours, pieces, pii, queries, rules

WORD = r"[^\x20\x09-\x0D]+"
public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def scraps(seed, n, size, parts):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, size))) for _ in range(n)]


# Pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


PARTS = ["a", "the", " ", "  ", "\n", "▁", "é", "漢", "😀", "\t", "<s>", "</s>", "<0x0A>", "　", "é", "\0", "tion", "\r\n", "1.5"]
TEXTS = [*scraps(3, 600, 25, PARTS), "", " ", "   ", "a" * 5000, "thing" * 900, " " * 777, "▁▁a▁"]


def test_ids_and_texts_equal_the_library(library):
    model = pieces.Pieces(open(MODEL, "rb").read())
    cuts = pieces.Cuts(model)
    for begin in range(0, len(TEXTS), 100):
        own = TEXTS[begin : begin + 100]
        offsets, ids, begins, ends = cuts.encoded(own)
        decoded = cuts.decoded(offsets, ids).to_pylist()
        for k, text in enumerate(own):
            at = slice(offsets[k], offsets[k + 1])
            wanted = library.encode(text)
            assert ids[at].tolist() == wanted
            assert decoded[k] == library.decode(wanted) == model.decode(wanted)
            if wanted:  # spans tile the source
                assert begins[at][0] == 0 and ends[at][-1] == len(text.encode())
                assert (begins[at][1:] == ends[at][:-1]).all()


def test_long_and_short_merges_agree():
    model = pieces.Pieces(open(MODEL, "rb").read())
    for text in ("internationalisation", "aaaaabaaaa", "▁▁▁▁▁the", "tionstions"):
        assert model.merge(text) == model._merge_long(list(text))


def test_bytes_that_fit_nowhere(library):
    model = pieces.Pieces(open(MODEL, "rb").read())
    for raw in (b"\xff", b"\xe6\xbc", b"a\xc3\xc3\xa9"):
        ids = [model.bytes[b] for b in raw]
        assert model.decode([model.ids["▁a"], *ids]) == library.decode([model.ids["▁a"], *ids])


def test_longest_matches_of_a_compiled_map():
    from sentencepiece import sentencepiece_model_pb2

    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", remove_extra_whitespaces=True)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    spec = proto.normalizer_spec
    model = pieces.Pieces(open(MODEL, "rb").read())
    model.map = pieces.CharacterMap(spec.precompiled_charsmap)
    model.prefix, model.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
    model.mark = pieces.BLANK if spec.escape_whitespaces else " "
    for text in ["ﬁne  ｱﾊﾟｰﾄ ①②", "  lead and trail  ", "été　x", "㍿", "a\tb\nc", "plain", ""]:
        normal, places = model.normalize(text)
        assert normal == normalizer.normalize(text)
        assert len(places) == len(normal) + 1 and places == sorted(places)


def test_encode_keeps_columns(documents, no_documents, library):
    rows = pieces.encode(documents, MODEL, keep=("doc_id", "node")).collect()
    assert len(rows) == documents.count()
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    for r in rows:
        assert r["ids"] == library.encode(texts[r["doc_id"]] or "")
        assert r["node"] == (None if r["doc_id"] is None else f"own {r['doc_id']}")
    assert pieces.encode(no_documents, MODEL).collect() == []


def test_tasks_need_no_tokenizer_library(spark, documents, tmp_path, monkeypatch):
    (tmp_path / "sentencepiece.py").write_text("raise ImportError('only the driver has it')\n")
    monkeypatch.setitem(spark.sparkContext.environment, "PYTHONPATH", str(tmp_path))
    assert len(pieces.encode(documents, MODEL).collect()) == documents.count()


def test_stretches_of_a_text_equal_the_whole(monkeypatch):
    cuts = pieces.Cuts(pieces.Pieces(open(MODEL, "rb").read()))
    own = [t for t in TEXTS if len(t) > 20][:120] + ["", "a" * 300, "漢字" * 50 + "▁ thing"]
    whole = cuts.encoded(own)
    texts = cuts.decoded(whole[0], whole[1])
    for stretch, run in ((1, 1), (9, 4)):
        monkeypatch.setattr(pieces, "STRETCH", stretch)
        monkeypatch.setattr(pieces, "RUN", run)
        parted = cuts.encoded(own)
        assert all(np.array_equal(a, b) for a, b in zip(whole, parted, strict=True))
        assert cuts.decoded(parted[0], parted[1]).equals(texts)


def test_a_long_text_takes_little_beside_its_ids():
    cuts = pieces.Cuts(pieces.Pieces(open(MODEL, "rb").read()))
    words = scraps(5, 3000, 4, ["a", "tion", "é", "th", "q", "漢"])
    text = " ".join(random.Random(6).choices(words, k=500_000))
    cuts.encoded([text[:20_000]])
    tracemalloc.start()
    offsets, ids, _, _ = cuts.encoded([text])
    cuts.decoded(offsets, ids)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 * len(ids)


def test_cuts_remembered_are_bounded_by_their_size(monkeypatch):
    monkeypatch.setattr(pieces, "HELD", 20_000, raising=False)
    cuts = pieces.Cuts(pieces.Pieces(open(MODEL, "rb").read()))
    rng = random.Random(7)
    for _ in range(40):
        cuts.encoded(["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(1000))])
        assert sum(map(len, cuts.numbers)) + len(cuts.ids) < 20_000 + 4 * 1001


def test_digests_of_long_and_odd_texts(spark, tmp_path, library):
    texts = [None, "", " ", "the thing", "one two " * 70_000, "漢" * 30_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op5_sentencepiece(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        ids = library.encode(text or "")
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert rows[k]["n_source_bytes"] == len((text or "").encode())


# Quality rules


def plain_counts(text):
    words = re.findall(WORD, text or "")
    triples = list(zip(words, words[1:], words[2:], strict=False))
    often = collections.Counter(triples)
    repeated = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(WORD, line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(repeated)


def test_counts_of_scraps():
    texts = [*scraps(2, 800, 40, ["a", "b", " ", "\n", "a b c ", "é", "#", "\x0b", "　", "A", "|"]), None, "", "\n"]
    counts = rules._counts(pa.array(texts, pa.string()))
    got = list(zip(*[counts[n].tolist() for n in rules.COUNTS], strict=True))
    assert got == [plain_counts(t) for t in texts]


def test_junk_goes_and_good_stays(spark):
    rng = random.Random(6)
    rows, labelled = [], []
    for k in range(240):
        own = [rng.choice(["stone", "river", "and", "the", "light", "over"]) + rng.choice("abcdefg") * rng.randint(0, 3) for _ in range(90)]
        if junk := k % 6 == 0:
            own = [w + "***" for w in own]
        rows.append((k, " ".join(own)))
        labelled.append((k, int(not junk)))
    rows += [(900, "too short"), (901, None), (902, ""), (903, "again " * 200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labelled[:200], "doc_id long, quality int")
    verdicts = {r["doc_id"]: r for r in rules.judged(frame, labels).collect()}
    assert [k for k, _ in rows if verdicts[k]["kept"]] == [k for k in range(240) if k % 6]
    assert sorted(k for k in verdicts if verdicts[k]["base_failed"]) == [900, 901, 902, 903]
    assert sorted(r["doc_id"] for r in rules.filtered(frame, labels).collect()) == [k for k in range(240) if k % 6]


def test_rules_on_odd_rows(documents, labels, no_documents, corpus):
    rows = rules.judged(documents, labels).collect()
    got = sorted(str((r["doc_id"], tuple(r[n] for n in rules.COUNTS))) for r in rows)
    assert got == sorted(str((i, plain_counts(t))) for i, t in corpus)
    # One kind of label only: the fixed rules alone decide.
    assert all(r["kept"] != r["base_failed"] for r in rows)
    kept = rules.filtered(documents, labels)
    assert kept.columns == documents.columns and kept.count() == sum(r["kept"] for r in rows)
    assert rules.judged(no_documents, labels).collect() == [] == rules.filtered(no_documents, None).collect()


# Neighbour votes


def test_votes_tell_held_out_rows_apart(spark):
    rng = random.Random(7)
    rows, labelled = [], []
    for k in range(400):
        good = k % 4 > 0
        stems = ["stone", "river", "light", "house"] if good else ["ZZ!!", "QX@@", "WW$$", "##KK"]
        rows.append((k, " ".join(rng.choice(stems) + str(rng.randint(0, 99)) for _ in range(rng.randint(8, 60)))))
        labelled.append((k, int(good)))
    frame = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "river light")], "doc_id long, text string")
    labels = spark.createDataFrame([*labelled, (None, 0), (5, None)], "doc_id long, quality int")
    found = {r["doc_id"]: r for r in neighbours.scored(frame, labels).collect()}
    held = [k for k in range(400) if found[k]["held_out"]]
    assert 90 < len(held) < 180
    assert all(found[k]["predicted"] == labelled[k][1] for k in held)
    assert 0 <= found[1000]["score"] == found[1001]["score"] <= 1 and not found[None]["held_out"]


def test_scores_are_the_votes_of_all_voters_and_do_not_depend_on_blocks(spark, documents, corpus):
    rows = [(i, int(len(t.split()) > 60)) for i, t in corpus if i is not None and t]
    halves = spark.createDataFrame(rows, "doc_id long, quality int")
    voters = neighbours.fitted(documents, halves)
    vectors = voters.vectors.T.astype(int).tolist()
    expected = {}
    for doc_id, text in corpus:
        counts = neighbours.trigram_counts(pa.array([text], pa.string()))
        own = voters.placed(counts)[0].astype(int).tolist()
        products = [sum(a * b for a, b in zip(own, v, strict=True)) for v in vectors]
        nearest = sorted(range(len(vectors)), key=lambda k: (-products[k], k))[: neighbours.NEIGHBOURS]
        near = {k: max(products[k] / neighbours.VECTOR_STEPS**2, 0) ** 4 for k in nearest}
        total = sum(near[k] * voters.votes[k] for k in nearest)
        good = sum(near[k] * voters.good[k] for k in nearest)
        expected.setdefault(doc_id, set()).add(round(good / total if total > 1e-12 else voters.share, 12))
    found = neighbours.scored(documents.repartition(7), halves).collect()
    assert len(found) == len(corpus)
    assert all(round(min(max(r["score"], 0), 1), 12) in expected[r["doc_id"]] for r in found)
    key = lambda r: (str(r["doc_id"]), r["score"])
    assert sorted(found, key=key) == sorted(neighbours.scored(documents.coalesce(1), halves).collect(), key=key)
    scores = [voters.score(neighbours.trigram_counts(pa.array([t] * n, pa.string()))) for t in (corpus[0][1], corpus[5][1]) for n in (1, 3, 300)]
    assert all(len(set(np.concatenate(scores[k : k + 3]))) == 1 for k in (0, 3))


def test_labels_of_held_out_rows_play_no_part(spark, documents, labels):
    import zlib

    flipped = labels.withColumn("quality", F.when(neighbours.held_out(), 0).otherwise(F.col("quality")))
    once = neighbours.scored(documents, labels).collect()
    assert once == neighbours.scored(documents, flipped).collect()
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in once)


def test_votes_without_documents(no_documents, labels):
    assert neighbours.scored(no_documents, labels).collect() == []
    assert neighbours.scored(no_documents, labels.limit(0)).collect() == []


# Personal data

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def is_valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    text = text or ""
    return [(k, m.start(), m.end()) for k in FIXED for m in re.finditer(FIXED[k], text) if is_valid(k, m.group())]


@pytest.fixture(scope="module")
def private(spark):
    parts = ["a", "é😀", "@", "b.c", ".", "x@y.z", "1", "23", "255.", "1.2.3.4", "0000255.1.1.1", "256.1.1.1", "+", "+4", " ", "-", "(", ")", "4111 1111-1111 1111", "4111111111111112", "_", "+1 (367) 555-7441", "token = \"2744c51c47b5a46acc1a1312\" "]
    texts = [*scraps(9, 700, 12, parts), None, "", "5" * 20000, "a" * 20000, "a.b" * 3000, "1.2.3.4 " * 700, "x@y.z" * 500, "- 1" * 3000, "+" + "1 " * 9000]
    return spark.createDataFrame([(k, t, "own", "own") for k, t in enumerate(texts)], "doc_id long, text string, email string, base string")


def test_base_spans_equal_plain_matching(private):
    found = pii.detected(private.select("doc_id", "text")).select("doc_id", "text", pii.written("base").alias("base"), pii.written("spans").alias("spans"))
    for r in found.collect():
        wanted = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(r["text"]))
        assert r["base"] == wanted
        assert r["spans"].startswith(wanted)


def test_redaction_leaves_the_rest(private):
    out = pii.redacted(private.withColumn("n_chars", F.length("text")))
    assert out.columns == [*private.columns, "n_chars"]
    before = {r["doc_id"]: r["text"] for r in private.collect()}
    for r in out.collect():
        assert (r["email"], r["base"]) == ("own", "own")
        if r["text"] is None:
            assert before[r["doc_id"]] is None
            continue
        assert r["n_chars"] == len(r["text"])
        kept = re.split(r"\[(?:EMAIL|IP|CARD|PHONE|CONTACT|NUMBER|SECRET)\]", r["text"])
        at = 0
        for piece in kept:  # what is left stands in the source, in order
            at = before[r["doc_id"]].index(piece, at) + len(piece)
        if not base_spans(before[r["doc_id"]]) and len(kept) == 1:
            assert r["text"] == before[r["doc_id"]]


def test_trees_add_what_the_rules_settle(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        name = "".join(rng.choice("abcdefghij") for _ in range(22)) + "7"
        rows.append((k, f'so the token = "{key}" and' if k % 2 else f"went to {name} and"))
    found = pii.detected(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["s"] for r in found.select("doc_id", pii.written("spans").alias("s")).collect()}
    assert all(("secret:" in got[k]) == bool(k % 2) for k in got)


def test_written_out_addresses_and_numbers_are_added_and_dates_are_not(spark):
    rng = random.Random(6)

    def digits(n):
        return str(rng.randint(2, 9)) + "".join(rng.choice("0123456789") for _ in range(n - 1))

    def name():
        return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))

    makers = [
        ("contact", lambda: ("ask ", f"{name()} (at) {name()} (dot) com")),
        ("contact", lambda: ("ask ", f"{name()} at {name()} dot com")),
        (None, lambda: ("he stood ", f"{name()} at {name()} dot {rng.choice(['matrix', 'paper', 'style'])}")),
        ("number", lambda: ("call me at ", f"{digits(3)}-{digits(3)}-{digits(4)}")),
        ("number", lambda: ("her ssn is ", f"{digits(3)}-{digits(2)}-{digits(4)}")),
        ("number", lambda: ("so we wrote down ", f"{digits(3)}-{digits(3)}-{digits(4)}")),
        (None, lambda: ("it came on ", f"20{rng.randint(10, 24)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}")),
        (None, lambda: ("a total of ", digits(rng.randint(7, 9)))),
        ("phone", lambda: ("or dial ", f"+1 {digits(3)}-{digits(3)}-{digits(4)}")),
    ]
    # Nearly all numbers stand in base spans.
    rows, wanted = [], {}
    for k in range(2700):
        kind, maker = makers[k % 9] if k < 900 else makers[8]
        lead, hit = maker()
        start = "y" * rng.randint(0, 9) + " "
        rows.append((k, f"{start}{lead}{hit} then"))
        at = len(start) + len(lead)
        wanted[k] = f"{kind}:{at}:{at + len(hit)}" if kind else ""
    found = pii.detected(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["s"] for r in found.select("doc_id", pii.written("spans").alias("s")).collect()}
    for place, (kind, _) in enumerate(makers):
        own = [k for k in wanted if k < 900 and k % 9 == place]
        right = sum(got[k] == wanted[k] for k in own)
        assert right >= 0.95 * len(own) if kind else right == len(own), (place, right, [(rows[k], got[k]) for k in own[:3]])


def test_nothing_to_find(no_documents, documents):
    assert pii.detected(no_documents).collect() == []
    assert pii.redacted(no_documents).collect() == []
    assert pii.redacted(documents).count() == documents.count()


# Chat windows

CONTROL = ["</s>", "[INST]", "[/INST]", "<|end|>\n", "<|user|>", "<\\|", "<\\\\s>", "<<SYS>>", "<</SYS>>", "<", "[", "\\", "|>", " ok ", "é", "\n", "<|"]


@pytest.fixture(scope="module")
def conversations():
    texts = scraps(5, 900, 14, CONTROL)
    rng = random.Random(2)
    rows = []
    for conv, n in enumerate([1, 2, 3, 7, 400, 30, 5]):
        for turn in range(n):
            role = "system" if turn == 0 and conv % 2 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, rng.choice(texts) * rng.randint(1, 20)))
    rows += [(50, 0, None, None), (50, 1, "assistant", None), (50, None, "tool|x", "late"), (None, 0, "user", "hm"), (None, 1, "assistant", "x " * 5000)]
    rows += [(60, 1, "assistant", "twice")] * 2 + [(61, 5000 * k, "assistant", "far") for k in range(3)]
    return rows


def test_windows_read_back(spark, conversations):
    frame = spark.createDataFrame([(*r, "own") for r in conversations], "conv_id long, turn long, role string, text string, window string")
    formatted = chat.windows(frame, stride=60, history=30)
    got = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    turns = collections.defaultdict(list)
    for conv, turn, role, text in conversations:
        turns[conv].append((turn is None, turn or 0, role or "", text or ""))
    assert set(got) == set(turns)
    for conv, own in turns.items():
        own.sort()
        said = "".join(t for *_, role, t in own if role == "assistant")
        lines = "".join(f"{role}\n{t}\n" for *_, role, t in own)
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(said))
        assert r["turns_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    rows = formatted.where("conv_id = 4").orderBy("window").collect()
    assert len(rows) > 20 and rows[0]["n_repeated"] == 0 and any(r["n_repeated"] > 0 for r in rows)
    system = formatted.where("conv_id = 5").orderBy("window").collect()
    assert len(system) > 1 and all(r["text"].startswith("<|system|>") for r in system)


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.windows(none)).collect() == []


def test_escapes_are_reversible(spark):
    texts = scraps(11, 500, 10, CONTROL)
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in frame.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", r["e"])


def test_random_words_are_odd():
    from kerbcast.llm.bytetext import random_words

    values = random_words(1, 1000)
    assert len(set(values.tolist())) == 1000 and (values & np.uint64(1)).all()
