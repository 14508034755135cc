"""Queries of the training-data operators, by contract, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.llm import (
    chat,
    hashing,
    minhash,
    mixing,
    neighbours,
    pieces,
    pii,
    prefixes,
    rollup,
    rules,
    suffixes,
    trie,
    whitening,
)
from kerbcast.llm.common import WORD, saved, shared_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.linked_components(table(spark, sf_dir, "documents")).drop("component")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detected(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def count(n: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long").alias(f"n_{pii.BASE[n]}")

    return found.select(
        "doc_id",
        *[count(n) for n in range(len(pii.BASE))],
        F.sha2(pii.written("base"), 256).alias("base_sha256"),
        pii.written("spans").alias("spans"),
    )


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    return chat.digests(chat.windows(rows.unionByName(own)))


def op4_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Ids written at once: a string for each of a long text's ids fills an executor.
_WRITTEN = 1 << 16


def _joined(ids: str) -> Column:
    """The ids with commas between them."""

    def join(some: Column) -> Column:
        return F.array_join(some.cast("array<string>"), ",")

    begins = F.sequence(F.lit(1), F.size(ids), F.lit(_WRITTEN))
    runs = F.transform(begins, lambda k: join(F.slice(ids, k, _WRITTEN)))
    return F.when(F.size(ids) <= _WRITTEN, join(F.col(ids))).otherwise(F.array_join(runs, ","))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(_joined("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_source_bytes"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "anomaly")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats_removed(table(spark, sf_dir, "documents"))


def op8_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.linked_vectors(table(spark, sf_dir, "embeddings"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source")


#: Words with a letter or digit, the revised count of the word tokenizer.
_SOUND = r"[^\x20\x09-\x0D]*[A-Za-z0-9][^\x20\x09-\x0D]*"


def op10_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: a load with two tokenizers (words, and
    bytes), the deletion of exact copies, revised word counts for what is left, and the
    deletion sent once more, which must change nothing."""
    text = F.coalesce("text", F.lit(""))
    docs = saved(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            "source",
            "lang",
            F.sha2(text, 256).alias("body"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
            F.regexp_count(text, F.lit(_SOUND)).cast("long").alias("sound"),
            F.octet_length(text).cast("long").alias("bytes"),
        ),
        "counted",
    )
    firsts = docs.groupBy("body").agg(F.min("doc_id").alias("first"))
    marked = saved(docs.join(firsts, "body").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))), "marked")

    def counts(rows: DataFrame) -> DataFrame:
        kinds = F.array(
            F.struct(F.lit("words-1").alias("version"), F.col("words").alias("tokens"), F.col("sound").alias("revised")),
            F.struct(F.lit("bytes-1").alias("version"), F.col("bytes").alias("tokens"), F.col("bytes").alias("revised")),
        )
        return rows.select("source", "lang", F.explode(kinds).alias("k")).select("source", "lang", "k.*")

    totals = rollup.TokenRollup(spark, shared_path(spark, "rollup"))
    copies = rollup.deletes(counts(marked.where("copy")))
    totals.commit("load", rollup.inserts(counts(docs)))
    totals.commit("copies", copies)
    totals.commit("recount", rollup.revisions(counts(marked.where("NOT copy")).where("version = 'words-1'")))
    totals.commit("copies", copies)
    return totals.totals()


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.fingerprinted(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_minhash": op1_minhash,
    "op2_pii": op2_pii,
    "op3_chat_windows": op3_chat_windows,
    "op4_quality_votes": op4_quality_votes,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_quality_rules": op6_quality_rules,
    "op7_repeats": op7_repeats,
    "op8_vector_links": op8_vector_links,
    "op9_source_mix": op9_source_mix,
    "op10_token_rollup": op10_token_rollup,
    "op11_whitening": op11_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fingerprints": op13_fingerprints,
}
ORACLES: dict[str, str] = {
    "op10_token_rollup": f"""
        WITH docs AS (
            SELECT doc_id, source, lang, coalesce(text, '') AS body,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
            FROM documents
        ), kept AS (
            SELECT source, lang, body FROM docs WHERE NOT coalesce(doc_id > first, false)
        ), counted AS (
            SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(body, '{_SOUND}')) AS tokens FROM kept
            UNION ALL
            SELECT source, lang, 'bytes-1', strlen(body) FROM kept
        )
        SELECT source, lang, version, count(*)::BIGINT AS n_docs, sum(tokens)::BIGINT AS n_tokens
        FROM counted GROUP BY source, lang, version
    """,
    # The checksum goes over the id's digits bit by bit; nodes are grouped by whole prefixes, and
    # a subtree is found through the nodes that its smallest member passes.
    "op12_prefix_trie": """
        WITH own AS (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                                 ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), summed AS (
            SELECT conv_id, turns, CAST(xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                      lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))
            ), 4294967295::BIGINT) % 9 AS INTEGER) AS h FROM own
        ), rebuilt AS (
            SELECT s.conv_id, list_concat(coalesce(b.turns, [])[:s.h], s.turns[s.h + 1:]) AS turns
            FROM summed s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 5
        ), passed AS (
            SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
        ), nodes AS (
            SELECT depth, turns[:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
                   strlen(any_value(turns[depth].t)) AS bytes,
                   coalesce(string_agg(CASE WHEN n = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
            FROM passed GROUP BY ALL
        ), family AS (
            SELECT p.depth, p.conv_id AS parent, c.conv_id FROM nodes c
            JOIN nodes p ON p.depth = c.depth - 1 AND p.prefix = c.prefix[:c.depth - 1]
        ), bearing AS (
            SELECT n.depth, n.conv_id, n.n_convs, n.ends, count(f.conv_id) AS n_children,
                   CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * n.bytes END AS worth
            FROM nodes n LEFT JOIN family f ON f.depth = n.depth AND f.parent = n.conv_id GROUP BY ALL
        ), above AS (
            SELECT b.depth, b.conv_id, p.depth AS top_depth, m.conv_id AS top, b.worth, b.n_children
            FROM bearing b JOIN passed p ON p.conv_id = b.conv_id AND p.depth <= b.depth
            JOIN nodes m ON m.depth = p.depth AND m.prefix = p.turns[:p.depth]
        ), subtrees AS (
            SELECT top AS conv_id, top_depth AS depth, sum(worth) AS saved, count(*) FILTER (n_children = 0) AS leaves
            FROM above GROUP BY ALL
        )
        SELECT b.conv_id, b.depth, f.parent AS parent_conv_id, b.n_convs, b.n_children,
               s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(b.ends) AS ends_sha256
        FROM bearing b JOIN subtrees s USING (conv_id, depth)
        LEFT JOIN family f ON f.depth = b.depth - 1 AND f.conv_id = b.conv_id
    """,
}
