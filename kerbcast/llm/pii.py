"""Personal data: fixed patterns, and candidate spans judged by boosted trees; DataFrame
operations only.

Fixed patterns give the base spans, which always count.  Generators of high recall propose
further spans, which may overlap: written-out addresses, long numbers, long tokens with
digits.  Each proposal is described by its format and by the text before it.  Gradient-
boosted trees learn from proposals whose nature a strict rule settles, on a sample bounded by
``SAMPLE`` rows.  Positive are written-out addresses in brackets, under a known top-level
domain or after a word such as mail; numbers after a word such as phone or account, and those
that hold a base phone or card number, which stand for such numbers without their plus; tokens
in a known key format or after an assignment to a secret's name.  Negative are other spoken
addresses, dates, amounts, decimals and plain runs of digits without such a word, other tokens.
Numbers that no rule settles are left to the trees.  The rest is calibration: over settled
proposals kept from training that touch no base span, each generator gets the lowest score that
``PRECISION`` of the proposals above it, and of those at it, are positive.  Proposals from that
score on that touch no base span are added, but for addresses and numbers settled as negative.
Trees become plain expressions, so a document is judged in the pass that reads it.

The patterns are written so that matching is linear: the runs they start in begin at a run's
start or at the last match's end, and loops give nothing back, which changes no match.

Results for odd rows: a null text counts as empty and has no spans; ids play no part, so
null and repeated ids are allowed; equal rows get equal spans; without proposals of both
natures nothing is added; an empty table gives an empty table.  Extra columns are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import saved

BASE = ("email", "ip", "card", "phone")
ADDED = ("contact", "number", "secret")
#: Bounds of what the trees learn from; the precision that thresholds are set for.
SAMPLE, TREES, TREE_DEPTH, PRECISION = 20_000, 10, 4, 0.9

_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "contact": rf"(?<!{_LOCAL}){_LOCAL}++(?: ?(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]++ ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z]{{2,10}}"
    r"| at [A-Za-z0-9-]++ dot [A-Za-z]{2,10})",
    "number": r"(?<![0-9A-Za-z])[0-9](?:[ ().\-/]{0,2}+[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+",
}
#: A text without these has no match of the kind.
_HINT = {"email": "@", "phone": "+"}
_NAMES = r"(?i)(pass(?:word|wd)?|token|secret|api.?key|key)"
#: What stands right before an address or a personal number.
_ASKED = {
    "contact": r"(?i)(?:^|[^a-z])(?:e-?mail|mail|contact|write|reach|address)(?: (?:me|us|him|her|them|to|is|at)){0,3}[^0-9a-z]*$",
    "number": r"(?i)(?:^|[^a-z])(?:tele)?(?:phone|tel|call|fax|mobile|cell|whatsapp|sms|ssn|social security|passport|iban|account|"
    r"acct|card|licen[cs]e|id)(?: (?:me|us|him|her|them|number|no|nr|at|on|is)){0,3}[^0-9a-z]*$",
}
#: Domains that are no words.
_DOMAIN = (
    r"(?i)(?:\.| dot |\(dot\)|\[dot\]) ?(?:com|org|net|edu|gov|mil|info|biz|io|uk|de|fr|nl|pl|se|fi|dk|ch|eu|ru|cn|jp|kr|br|"
    r"ca|nz|mx|za)$"
)
#: Words before "at" that are no mailbox.
_NO_BOX = (
    r"(?i)^(?:us|me|it|them|him|her|you|here|there|is|are|was|were|be|out|not|and|or|more|online|available|shop|look|looking|visit|see|"
    r"found|live|buy|sold|read|meet|work|works|working|arrived?|store|site|website) at "
)
_YEAR, _MONTH, _DAY = "(?:19|20)[0-9]{2}", "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
_DATE = (
    rf"^(?:{_YEAR}[-./ ]{_MONTH}[-./ ]{_DAY}|{_DAY}[-./ ]{_MONTH}[-./ ]{_YEAR}|{_MONTH}[-./ ]{_DAY}[-./ ]{_YEAR})"
    rf"(?:[ -][0-9]{{1,2}})?$|^{_YEAR} ?[-/ ] ?{_YEAR}$"
)
#: Plain runs, decimals, dotted versions, thousands.
_AMOUNT = r"^[0-9]+(?:\.[0-9]+)?$|^[0-9]+(?:\.[0-9]+){3,}$|^[0-9]{1,3}(?:\.[0-9]{3})+$|^[0-9]{1,3}(?: [0-9]{3})* 000$"
_UNIT = r"[$€£¥#]\s*$|[0-9][.,]$"
_RUN = 256


def _before(lengths: Column) -> Column:
    """For each element the sum of those before it, in runs so that long arrays stay cheap."""
    start = F.array(F.lit(0).cast("long"))

    def sums(values: Column) -> Column:
        return F.aggregate(values, start, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _RUN).cast("int")),
        lambda r: sums(F.slice(lengths, r * _RUN + 1, F.lit(_RUN))),
    )
    bases = sums(F.transform(runs, lambda r: F.element_at(r, -1)))
    return F.flatten(
        F.transform(F.arrays_zip(runs.alias("r"), F.slice(bases, 1, F.size(runs)).alias("b")), lambda z: F.transform(
            F.slice(z["r"], F.lit(1), F.size(z["r"]) - 1), lambda x: x + z["b"]))
    )


def _with_matches(rows: DataFrame, kind: str, text: str) -> DataFrame:
    """Adds ``kind``: the matches as (start, end, hit), in code points, end exclusive."""
    found = F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))
    none = F.array().cast("array<string>")
    if kind in _HINT:
        found = F.when(F.instr(F.col(text), _HINT[kind]) > 0, found).otherwise(none)
    rows = rows.withColumn("__hits", found)
    gaps = F.split(F.col(text), PATTERNS[kind], -1)
    rows = rows.withColumn("__gaps", F.when(F.size("__hits") > 0, gaps))
    # Lengths of gap, hit, gap, hit, ...: a hit starts where all before it end.
    sizes = F.flatten(
        F.transform("__hits", lambda h, i: F.array(F.length(F.get("__gaps", i)).cast("long"), F.length(h).cast("long")))
    )
    rows = rows.withColumn("__sizes", F.when(F.size("__hits") > 0, sizes))
    rows = rows.withColumn("__starts", F.when(F.size("__hits") > 0, _before(F.col("__sizes"))))
    spans = F.transform(
        "__hits",
        lambda h, i: F.struct(
            F.get("__starts", i * 2 + 1).alias("start"),
            (F.get("__starts", i * 2 + 1) + F.length(h)).alias("end"),
            h.alias("hit"),
        ),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    return rows.withColumn(kind, F.when(F.size("__hits") > 0, spans).otherwise(empty)).drop(
        "__hits", "__gaps", "__sizes", "__starts"
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    digits = _digits(span["hit"])
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return span["hit"].rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), _luhn(digits))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _features(generator: int, span: Column, before: Column, after: Column) -> Column:
    hit = span["hit"]
    size = F.length(hit).cast("double")
    return F.array(
        F.lit(float(generator)),
        F.least(size, F.lit(99.0)),
        F.least(_count(hit, "[0-9]"), F.lit(64.0)),
        _count(hit, "[A-Z]") / size,
        _count(hit, "[a-z]") / size,
        F.least(_count(hit, r"[ ().\-/]"), F.lit(32.0)),
        F.least(_count(hit, "[0-9]+"), F.lit(32.0)),
        F.least(_count(hit, r"\."), F.lit(32.0)),
        F.size(F.array_distinct(F.split(F.substring(hit, 1, 64), ""))).cast("double"),
        before.rlike(r"[=:]\s*[\"']?$").cast("double"),
        before.rlike(_NAMES).cast("double"),
        before.rlike(r"(?i)(mail|contact|phone|tel|call|card|account|server|host|ssn|iban)").cast("double"),
        after.rlike(r"^[A-Za-z0-9@]").cast("double"),
        before.rlike(_ASKED["contact"]).cast("double"),
        before.rlike(_ASKED["number"]).cast("double"),
        hit.rlike(_DOMAIN).cast("double"),
        hit.rlike(_NO_BOX).cast("double"),
        _count(hit, r"[(\[](?:at|dot)[)\]]"),
        hit.rlike(_DATE).cast("double"),
        hit.rlike(_AMOUNT).cast("double"),
        before.rlike(_UNIT).cast("double"),
    )


def _settled(kind: str, span: Column, before: Column, touched: dict[str, Column]) -> Column:
    """The nature of a proposal by strict rules; null where they do not settle it."""
    hit = span["hit"]
    if kind == "secret":
        settled = hit.rlike("^AKIA[0-9A-Z]{16}$") | before.rlike(rf"{_NAMES}[\"' ]*[:=][\"' ]*$")
        return F.coalesce(settled, F.lit(False))
    asked = before.rlike(_ASKED[kind])
    if kind == "contact":
        bracketed = hit.rlike(r"[(\[]at[)\]] ?[A-Za-z0-9-]+ ?[(\[]dot[)\]]")
        positive = asked | bracketed | (hit.rlike(_DOMAIN) & ~hit.rlike(_NO_BOX))
        return F.when(~reduce(Column.__or__, touched.values()), positive)
    return (
        F.when(touched["phone"] | touched["card"], True)
        .when(touched["email"] | touched["ip"], None)
        .when(hit.rlike(_DATE), False)
        .when(asked, True)
        .when(hit.rlike(_AMOUNT) | before.rlike(_UNIT), False)
    )


def scanned(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``base`` spans (kind, start, end) and ``proposed`` ones with their
    generator, features and settled nature."""
    rows = documents.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for kind in (*BASE, *ADDED):
        rows = _with_matches(rows, kind, "__text")

    def fixed(n: int, kind: str) -> Column:
        return F.transform(
            F.filter(kind, lambda s: _valid(kind, s)),
            lambda s: F.struct(F.lit(n).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )

    base = [fixed(n, kind) for n, kind in enumerate(BASE)]
    rows = rows.withColumn("base", F.concat(*base))

    def describe(n: int, kind: str) -> Column:
        def one(span: Column) -> Column:
            lead = F.least(span["start"], F.lit(32))
            before = F.substring(F.col("__text"), (span["start"] - lead + 1).cast("int"), lead.cast("int"))
            after = F.substring(F.col("__text"), (span["end"] + 1).cast("int"), F.lit(2))
            over = F.filter("base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
            kinds = F.transform(over, lambda b: b["kind"])
            touched = {base: F.array_contains(kinds, i) for i, base in enumerate(BASE)}
            return F.struct(
                F.lit(n).alias("kind"),
                span["start"].alias("start"),
                span["end"].alias("end"),
                _features(n, span, before, after).alias("x"),
                _settled(kind, span, before, touched).alias("positive"),
                (F.size(over) > 0).alias("touches"),
            )

        return F.transform(kind, one)

    proposed = F.concat(*[describe(n, kind) for n, kind in enumerate(ADDED)])
    return rows.withColumn("proposed", proposed).drop("__text", *BASE, *ADDED)


def _tree(node, x: Column) -> Column:
    """A fitted tree as nested conditions on the features."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    left = F.get(x, F.lit(int(split.featureIndex()))) <= F.lit(float(split.threshold()))
    return F.when(left, _tree(node.leftChild(), x)).otherwise(_tree(node.rightChild(), x))


class Judge:
    """Boosted trees over features, and the score from which a generator's spans count."""

    def __init__(self, model, limits: dict[int, float]) -> None:
        self.model, self.limits = model, limits

    def score(self, x: Column) -> Column:
        trees = self.model._java_obj.trees()
        margin = reduce(
            Column.__add__, [_tree(t.rootNode(), x) * F.lit(float(w)) for t, w in zip(trees, self.model.treeWeights, strict=True)]
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2))

    def added(self) -> Column:
        """The proposals that count, as (kind, start, end); kinds go on after the base's."""
        limits = F.array(*[F.lit(self.limits.get(n, 2.0)) for n in range(len(ADDED))])

        def counts(p: Column) -> Column:
            open_ = (p["kind"] == ADDED.index("secret")) | F.coalesce(p["positive"], F.lit(True))
            return ~p["touches"] & open_ & (self.score(p["x"]) >= F.get(limits, p["kind"]))

        chosen = F.filter("proposed", counts)
        return F.transform(
            chosen,
            lambda p: F.struct((p["kind"] + len(BASE)).alias("kind"), p["start"].alias("start"), p["end"].alias("end")),
        )


def fitted(scan: DataFrame) -> Judge | None:
    """Trees and limits learnt from a saved ``scanned`` table; None where there is nothing
    to tell apart."""
    proposals = saved(
        scan.where(F.size("proposed") > 0)
        .select(F.explode("proposed").alias("p"))
        .where("p.positive IS NOT NULL")
        .select("p.kind", "p.x", "p.touches", F.col("p.start").alias("place"), F.col("p.positive").cast("double").alias("label"))
        .withColumn("turn", F.pmod(F.xxhash64("place", "x"), F.lit(4))),
        "proposals",
    )
    learning = proposals.where("turn > 0")
    counts = {r["label"]: r["count"] for r in learning.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = min(1.0, SAMPLE / sum(counts.values()))
    sample = learning.where(F.pmod(F.xxhash64("x", "place", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = saved(sample.select(array_to_vector("x").alias("features"), "label").coalesce(4), "sample")
    if sample.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, seed=5, maxMemoryInMB=64).fit(sample)
    judge = Judge(model, {})
    scored = proposals.where("turn = 0 AND NOT touches").select(
        "kind", F.floor(judge.score(F.col("x")) * 1000).alias("bin"), "label"
    )
    bins = scored.groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).collect()
    for kind in range(len(ADDED)):
        n = good = 0
        for row in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, good = n + row["n"], good + row["good"]
            if good >= PRECISION * n and row["good"] >= PRECISION * row["n"]:
                judge.limits[kind] = row["bin"] / 1000
    return judge


def detected(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``base`` and ``spans``, all spans: (kind, start, end) in code
    points, kind a place in BASE + ADDED, ordered."""
    scan = saved(scanned(documents, text), "scan")
    judge = fitted(scan)
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    spans = F.array_sort(F.concat("base", judge.added() if judge else none))
    return scan.withColumn("spans", spans).withColumn("base", F.array_sort("base")).drop("proposed")


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with every span of personal data replaced by its kind in brackets;
    overlapping spans go together under the first one's kind.  n_chars is the new length."""
    own = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"), documents["text"].alias("text"))
    found = detected(own)
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def join(merged: Column, s: Column) -> Column:
        last = F.element_at(merged, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        whole = F.concat(F.slice(merged, F.lit(1), F.size(merged) - 1), F.array(grown))
        return F.when((F.size(merged) > 0) & (s["start"] < last["end"]), whole).otherwise(F.concat(merged, F.array(s)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:int>>")
    merged = F.aggregate("__order", empty, join)
    rows = found.withColumn("__order", order).withColumn("__merged", merged)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in (*BASE, *ADDED)])

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.get("__merged", i - 1)["end"]).otherwise(F.lit(0))
        kept = F.substring(F.col("text"), (begin + 1).cast("int"), (s["start"] - begin).cast("int"))
        return F.concat(kept, F.get(names, s["kind"]))

    tail = F.substring(F.col("text"), (F.element_at("__merged", -1)["end"] + 1).cast("int"), F.length("text"))
    clean = F.concat(F.array_join(F.transform("__merged", piece), ""), tail)
    rows = rows.withColumn("text", F.when(F.size("__merged") > 0, clean).otherwise(F.col("text")))
    new = {"text": F.col("text")}
    if "n_chars" in documents.columns:
        changed = F.length("text").cast(documents.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("__merged") > 0, changed).otherwise(F.col("row")["n_chars"])
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in documents.columns])


def written(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*BASE, *ADDED)])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
