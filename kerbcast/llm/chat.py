"""Chat formatting in budgeted windows, with DataFrame operations only.

A conversation becomes windows: texts of whole turns that fit a token budget.  The running
sum of turn tokens chooses where a window begins: turns whose sum falls into the same stretch
of ``stride`` tokens are the window's own.  Before them stand the system turn and as many
of the last earlier turns as fit ``history`` tokens; these repeated turns are masked, as are
all turns that are not the assistant's.  So each assistant text is under the loss mask once.

A turn is written ``<|role|>text<|end|>`` and a line feed.  Control strings inside a text,
this template's and those of common tokenizers, get a backslash after their first character
(one more if some stand there already), which reading takes out again; roles are
percent-encoded.

Turns are gathered by conversation and stretch of ``RUN`` turn numbers, so no task holds a
whole conversation however long it is; history does not reach back over a stretch's start.

Results for odd rows: a null text or role counts as empty; null conversation ids form one
conversation; turns are ordered by number (null last), then role and text, so repeated rows
stand side by side; a turn over the budget gets its own window, whole; an empty table gives
an empty table.  Extra columns of any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import WORD

STRIDE, HISTORY, RUN = 768, 192, 4096
#: Control strings of this template and of common tokenizers, without their first character.
CONTROL = r"(?=\||s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|BOS>|EOS>|eos>|bos>|pad>|unk>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){CONTROL}", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){CONTROL}", r"$1$2")


def windows(conversations: DataFrame, stride: int = STRIDE, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, text, n_repeated, loss): the formatted windows.

    window orders a conversation's windows; n_repeated counts the turns at the start of the
    text that earlier windows have; loss lists (start, length) in code points of the text
    under the loss mask.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    run = F.coalesce(F.floor(F.col("turn") / RUN), F.lit(2**62)).alias("run")
    tokens = F.regexp_count(F.col("text"), F.lit(WORD)).cast("long")
    header = F.concat(F.lit("<|"), F.url_encode("role"), F.lit("|>"))
    body = escaped(F.col("text"))
    shaped = turns.select(
        "conv_id",
        run,
        F.struct(
            F.coalesce("turn", F.lit(2**62)).alias("turn"),
            "role",
            (tokens + 4).alias("tokens"),
            F.length(header).alias("lead"),
            F.length(body).alias("body"),
            F.concat(header, body, F.lit("<|end|>\n")).alias("line"),
        ).alias("t"),
    )
    # The first turn of all is kept in later windows if it is the system's.
    first = shaped.groupBy("conv_id").agg(F.min(F.struct("t.turn", "t.role", "t")).alias("first"))
    system = first.where("first.role = 'system'").select(
        F.col("conv_id").alias("__conv"), F.col("first.t").alias("system")
    )
    gathered = shaped.groupBy("conv_id", "run").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    gathered = gathered.join(system, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")

    # Running sums before each turn, then the stretch each turn starts in.
    sums = F.aggregate(
        "turns",
        F.array(F.lit(0).cast("long")),
        lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t["tokens"])),
    )
    summed = gathered.withColumn("sums", sums)
    numbered = F.transform("turns", lambda t, i: F.struct(i.alias("i"), F.floor(F.get("sums", i) / stride).alias("w")))
    starts = summed.withColumn("numbered", numbered).select(
        "conv_id", "run", "turns", "system", "sums", "numbered",
        F.explode(F.array_distinct(F.transform("numbered", lambda x: x["w"]))).alias("w"),
    )
    own = F.filter("numbered", lambda x: x["w"] == F.col("w"))
    bounds = starts.withColumn("begin", F.element_at(own, 1)["i"]).withColumn("n", F.size(own))
    # Earlier turns whose tokens, with all after them up to the window, fit the history.
    fits = F.filter(
        F.sequence(F.lit(0), F.col("begin")),
        lambda i: F.get("sums", F.col("begin")) - F.get("sums", i) <= history,
    )
    reach = bounds.withColumn("back", F.element_at(fits, 1))
    head = F.when(
        F.col("system").isNotNull() & ((F.col("run") > F.floor(F.col("system.turn") / RUN)) | (F.col("back") > 0)),
        F.array("system"),
    ).otherwise(F.slice("turns", 1, 0))
    shown = reach.select(
        "conv_id",
        F.struct("run", "w").alias("window"),
        (F.size(head) + F.col("begin") - F.col("back")).alias("n_repeated"),
        F.concat(head, F.slice(F.col("turns"), F.col("back") + 1, F.col("begin") - F.col("back") + F.col("n"))).alias("shown"),
    )
    offsets = F.aggregate(
        "shown",
        F.array(F.lit(0).cast("long")),
        lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + F.length(t["line"]))),
    )
    spans = F.transform(
        "shown",
        lambda t, i: F.struct(
            i.alias("i"),
            t["role"].alias("role"),
            (F.get("offsets", i) + t["lead"]).alias("start"),
            t["body"].cast("long").alias("length"),
        ),
    )
    asked = F.filter(spans, lambda x: (x["i"] >= F.col("n_repeated")) & (x["role"] == "assistant"))
    return shown.withColumn("offsets", offsets).select(
        "conv_id",
        "window",
        F.array_join(F.transform("shown", lambda t: t["line"]), "").alias("text"),
        "n_repeated",
        F.transform(asked, lambda x: F.struct(x["start"], x["length"])).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, asked): the turns that a window has first, as (role, text),
    and the texts under its loss mask, all read from the formatted text."""
    pattern = r"(?s)<\|[^|<>]*\|>.*?<\|end\|>\n"
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    new = F.slice(found, F.col("n_repeated") + 1, F.greatest(F.size(found) - F.col("n_repeated"), F.lit(0)))

    def turn(x: Column) -> Column:
        close = F.instr(x, "|>")
        return F.struct(
            F.url_decode(F.substring(x, F.lit(3), close - 3)).alias("role"),
            unescaped(F.substring(x, close + 2, F.length(x) - close - 9)).alias("text"),
        )

    return formatted.select(
        "conv_id",
        "window",
        F.transform(new, turn).alias("turns"),
        F.transform(
            "loss",
            lambda s: unescaped(F.substring(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ).alias("asked"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """One row a conversation with digests of what ``read_back`` gives, in order."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read_back(formatted).select(
        "conv_id",
        F.struct(
            "window", F.size("turns").cast("long").alias("n"), lines.alias("lines"),
            F.array_join("asked", "").alias("asked"), "formatted_chars",
        ).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    total = lambda name: F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p[name])
    joined = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("lines"), 256).alias("turns_sha256"),
        F.length(joined("asked")).cast("long").alias("loss_chars"),
        F.sha2(joined("asked"), 256).alias("loss_sha256"),
        total("formatted_chars").alias("formatted_chars"),
        F.size("parts").cast("long").alias("n_windows"),
    )
