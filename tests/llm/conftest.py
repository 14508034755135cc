import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [rng.choice("abcdefghij") * rng.randint(1, 3) + rng.choice(["an", "ou", "st", "é", "x"]) + str(rng.randint(0, 9)) for _ in range(n)]


def edited(rng, text, share):
    """The text with a share of its words replaced."""
    out = text.split(" ")
    for k in rng.sample(range(len(out)), max(1, int(share * len(out)))):
        out[k] = words(rng, 1)[0] + "new"
    return " ".join(out)


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with copies, near copies, shared passages and odd rows."""
    rng = random.Random(8)
    passage = " ".join(words(rng, 70))
    texts = []
    for _ in range(40):
        texts.append(" ".join(words(rng, rng.randint(5, 160))))
    for base in texts[:12]:
        texts += [base, edited(rng, base, 0.01), edited(rng, base, 0.03), edited(rng, base, 0.1)]
    for k in range(12):
        texts.append(" ".join(words(rng, rng.randint(0, 60))) + "\n" + passage + " " + " ".join(words(rng, k)))
    texts += [None, "", " \t\n", None, "one", "One", "one two three", "same same " * 400, "ab" * 3000, "ü" * 500]
    return [(10 * k + 3, t) for k, t in enumerate(texts)] + [(None, texts[3]), (3, texts[0]), (3, texts[0])]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with the columns of documents and columns that operators use inside."""
    rows = [(i, t, "en", f"src{k % 4}" if k % 9 else None, len(t or "")) for k, (i, t) in enumerate(corpus)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("node", "size", "spans", "base", "email", "kept", "key", "score", "copy", "taken", "ids", "n"):
        frame = frame.selectExpr("*", f"concat('own ', doc_id) AS {name}")
    return frame


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, corpus):
    rows = [(i, 1, 0) for i, t in corpus if i is not None and t] + [(None, 1, 0), (3, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
