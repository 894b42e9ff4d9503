"""Personal data by candidate gradient boosting, with built-in functions only.

High-recall generators propose spans, which may overlap: the base kinds, any row of digits with separators, spelt-out mail
addresses, addresses without a dot, account numbers. Spans that a base rule accepts are always redacted. The others are
judged by boosted trees over their format and context. The trees learn from the candidates themselves: those a base rule
accepts are positive, the other candidates negative, and neither the rule's outcome nor the checksum is a feature.
Thresholds for each kind are calibrated on the candidates of all documents that the trees did not see, a third of them by
hash: the lowest rounded score from which on at least `PRECISION` of the candidates are positive; where there is none,
nothing of that kind is added.

Fitting reads all whole texts once and writes the features of all candidates. Trees are fitted by Spark's own learner on a
bounded sample of them, about `SAMPLE_ROWS` of each kind, drawn by hash. They become one column expression, so that scoring
is part of a second scan, without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilcount.llm import spans
from veilcount.session import new_work_folder

#: Candidates of each kind that the trees are fitted on, about.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 10, 4
PRECISION = 0.95
#: Fewest candidates of each class, and of each kind for its threshold, to learn anything from.
LEAST = 30
#: Decimal places of a score, which bound the rows of its histogram.
PLACES = 4
#: Fewest digits of a candidate card or phone number.
LEAST_DIGITS = 7
#: Code points of context before and after a candidate.
CONTEXT = 32

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that no start is tried twice. A match can only begin where a run of its
#: first signs begins or where the match before ended, and takes the same signs either way.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What follows the at of a spelt-out mail address.
_HOST = r"[A-Za-z0-9-]{1,63}\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,24}"
#: Further generators, by the kind they propose, with their gates.
PROPOSALS = (
    (
        "email",
        "spelt",
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?{_HOST}",
    ),
    ("email", "at", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}"),
    ("ip", "colons", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"),
    ("card", "digits", r"(?<![0-9])[0-9]{4}[\x20.-]?[0-9]{4,6}[\x20.-]?[0-9]{4,5}(?:[\x20.-]?[0-9]{1,4})?"),
    ("phone", "digits", r"(?<![0-9+])(?:\(?0[0-9]{1,5}\)?[\x20./-]?)[0-9]{2,5}(?:[\x20./-]?[0-9]{2,5}){1,3}"),
    ("phone", "digits", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
#: Words around a candidate that speak for a kind.
HINTS = (
    r"(?i:e-?mail|mail|contact|correo|courriel|write|schreib)",
    r"(?i:\bip\b|address|host|server|login|adresse)",
    r"(?i:card|visa|master|amex|credit|karte|carte|tarjeta|iban|account|konto|compte)",
    r"(?i:phone|tel\b|call|fax|mobile|cell|telefon|t\u00e9l\u00e9phone|llam)",
)
#: Zeros, then up to 255 without leading zeros; each part is read in one way only.
_OCTET = "(?=[0-9])0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    signs = F.split(F.reverse(digits), "")

    def value(sign: Column, place: Column) -> Column:
        twice = sign.cast("int") * (1 + place % 2)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(signs, value), F.lit(0), lambda total, item: total + F.coalesce(item, F.lit(0)))
    return total % 10 == 0


def _accepted(kind: str, hit: Column) -> Column:
    digits = _digits(hit)
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def _when(gate: Column, found: Column) -> Column:
    """Runs a pattern only over texts that hold what every match of it needs."""
    return F.when(gate, found).otherwise(F.array().cast(spans.SPANS))


#: What a text must hold for any match of some patterns: cheap tests, one pass each.
GATES = {
    "at": lambda text: F.contains(text, F.lit("@")),
    "spelt": lambda text: F.contains(text, F.lit("@"))
    | F.contains(text, F.lit("(at)"))
    | F.contains(text, F.lit("[at]"))
    | text.rlike(rf"\x20at\x20\x20?{_HOST}"),
    "digits": lambda text: text.rlike(r"[0-9][\x20()./0-9-]{5}[\x20()./0-9-]*+"),
    "colons": lambda text: text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
    "plus": lambda text: F.contains(text, F.lit("+")),
}


def gated(documents: DataFrame, text: str) -> DataFrame:
    """`documents` with a column `gates` of the outcomes, computed once for all patterns."""
    return documents.withColumn("gates", F.struct(*(test(F.col(text)).alias(name) for name, test in GATES.items())))


def _matches(text: Column, gates: Column) -> list[tuple[str, Column]]:
    return [
        ("email", _when(gates["at"], spans.find(text, EMAIL))),
        ("ip", _when(gates["digits"], spans.find(text, IP))),
        ("card", _when(gates["digits"], spans.find(text, CARD))),
        ("phone", _when(gates["plus"], spans.find(text, PHONE))),
    ]


def base_spans(text: Column, gates: Column) -> Column:
    """The accepted spans of the base kinds of a prepared text, by kind and then start."""

    def accepted(found: Column, kind: str) -> Column:
        return F.filter(found, lambda span: _accepted(kind, span["hit"]))

    return F.concat(
        *(spans.tagged(accepted(found, kind), kind, rank) for rank, (kind, found) in enumerate(_matches(text, gates)))
    )


def _proposed(text: Column, gates: Column) -> Column:
    """Candidates of all generators; what several of them propose stays once for each kind.

    Cards and phones of fewer than `LEAST_DIGITS` digits are left out; no base rule accepts one below nine.
    """
    base = [spans.tagged(found, kind, KINDS.index(kind)) for kind, found in _matches(text, gates)]
    more = [
        spans.tagged(_when(gates[gate], spans.find(text, pattern)), kind, KINDS.index(kind)) for kind, gate, pattern in PROPOSALS
    ]
    several_digits = lambda span: ~span["kind"].isin("card", "phone") | (F.char_length(_digits(span["hit"])) >= LEAST_DIGITS)
    return F.filter(F.array_distinct(F.concat(*base, *more)), several_digits)


def _described(text: Column, candidates: Column) -> Column:
    """Each candidate with the array `x` of its features."""

    def features(span: Column) -> Column:
        hit, digits = span["hit"], _digits(span["hit"])
        size = F.char_length(hit)
        before = F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)).cast("int"), F.least(span["start"], F.lit(CONTEXT)).cast("int"))
        after = F.substring(text, (span["stop"] + 1).cast("int"), F.lit(CONTEXT))
        flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
        groups = F.filter(F.split(hit, "[^0-9]+"), lambda group: group != "")
        longest = F.coalesce(F.array_max(F.transform(groups, F.char_length)), F.lit(0))
        shortest = F.coalesce(F.array_min(F.transform(groups, F.char_length)), F.lit(0))
        return F.array(
            span["rank"].cast("double"),
            size.cast("double"),
            F.char_length(digits).cast("double"),
            F.size(groups).cast("double"),
            longest.cast("double"),
            shortest.cast("double"),
            F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
            flag(F.startswith(hit, F.lit("+"))),
            flag(F.startswith(digits, F.lit("0"))),
            flag(F.contains(hit, F.lit("("))),
            flag(F.contains(hit, F.lit("."))),
            flag(F.contains(hit, F.lit("-"))),
            flag(F.contains(hit, F.lit(" "))),
            flag(hit.rlike(r"\.[A-Za-z]{2,24}$")),
            flag(before.rlike(r"[A-Za-z0-9]$")),
            flag(before.rlike(r"[=:(<\"']\x20?$")),
            flag(after.rlike(r"^[A-Za-z0-9]")),
            flag(after.rlike(r"^[.,;]?(?:\s|$)")),
            *(flag(F.concat_ws(" ", before, after).rlike(hint)) for hint in HINTS),
        )

    return F.transform(
        candidates, lambda span: F.struct(span["rank"], span["start"], span["stop"], span["kind"], span["hit"], features(span).alias("x"))
    )


@dataclass
class Model:
    """The trees as nested (feature, threshold, left, right) or leaf values, their weights, and a score for each kind."""

    trees: list = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, x: Column) -> Column:
        """The chance of the positive class: a logistic curve over twice the weighted sum of the trees."""

        def of(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(x[feature] <= threshold, of(left)).otherwise(of(right))

        total = sum((of(tree) * weight for tree, weight in zip(self.trees, self.weights)), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * total))


def _tree(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return split.featureIndex(), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def fit_on(documents: DataFrame) -> Model:
    """Fits trees and thresholds on candidates of `documents`; without enough of both classes nothing is added."""
    spark = documents.sparkSession
    text = documents.select("doc_id", spans.prepared(F.col("text")).alias("text"))
    proposed = gated(text, "text").select("doc_id", "text", _proposed(F.col("text"), F.col("gates")).alias("found"))
    wide = proposed.select("doc_id", _described(F.col("text"), F.col("found")).alias("found"))
    rows = wide.select("doc_id", F.explode("found").alias("span"))
    accepted = F.coalesce(*(F.when(F.col("span.kind") == kind, _accepted(kind, F.col("span.hit")) & _whole(kind, F.col("span.hit"))) for kind in KINDS))
    labelled = rows.select(
        F.col("span.kind").alias("kind"),
        F.when(accepted, 1.0).otherwise(0.0).alias("label"),
        F.col("span.x").alias("x"),
        F.xxhash64(F.col("doc_id").cast("string"), "span.start", "span.kind").alias("dealt"),
    )
    folder = new_work_folder(spark, "candidates")
    labelled.write.parquet(f"{folder}/all")
    candidates = spark.read.parquet(f"{folder}/all")
    calibrating = F.pmod("dealt", F.lit(3)) == 0
    counts = {row.kind: row["count"] for row in candidates.where(~calibrating).groupBy("kind").count().collect()}
    if not counts:
        return Model()
    share = F.coalesce(*(F.when(F.col("kind") == kind, min(1.0, SAMPLE_ROWS / count)) for kind, count in counts.items()))
    drawn = F.crc32(F.concat(F.lit("sample|"), F.col("dealt").cast("string"))) < share * 2**32
    width = 18 + len(HINTS)
    flat = candidates.where(~calibrating & drawn).select("kind", "label", "dealt", *(F.col("x")[at].alias(f"x{at}") for at in range(width)))
    features = [f"x{at}" for at in range(width)]
    flat.repartition(8, "dealt").sortWithinPartitions("dealt", "kind", "label", *features).write.parquet(f"{folder}/sample")
    learning = spark.read.parquet(f"{folder}/sample").coalesce(1)  # bounded; one task adds up in one order
    classes = {row.label: row["count"] for row in learning.groupBy("label").count().collect()}
    if min(classes.get(0.0, 0), classes.get(1.0, 0)) < LEAST:
        return Model()
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(learning)
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(assembled.select("label", "features"))
    model = Model([_tree(tree._java_obj.rootNode()) for tree in fitted.trees], list(fitted.treeWeights))
    scored = candidates.where(calibrating).select("kind", "label", _rounded(model.score(F.col("x"))).alias("score"))
    steps = scored.groupBy("kind", "score").agg(F.sum("label").alias("positive"), F.count("*").alias("total")).collect()  # at most 10**PLACES + 1 a kind
    for kind in KINDS:
        found = sorted((row.score, row.positive, row.total) for row in steps if row.kind == kind)
        if sum(total for *_, total in found) >= LEAST:
            model.thresholds[kind] = _calibrated(found)
    return model


def _whole(kind: str, hit: Column) -> Column:
    """Whether a proposed span has the form of the base kind from end to end."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    return hit.rlike(f"^(?:{pattern})$")


def _rounded(score: Column) -> Column:
    return F.round(score, PLACES)


def _calibrated(found: list[tuple[float, float, int]]) -> float:
    """The lowest score from which on enough of the candidates are positive, by score, positive and all candidates."""
    best, positive, count = math.inf, 0.0, 0
    for score, more, total in reversed(found):
        positive, count = positive + more, count + total
        if count >= LEAST // 3 and positive / count >= PRECISION:
            best = score
    return best


def find_personal_data(documents: DataFrame, model: Model) -> DataFrame:
    """`documents` with the arrays `base` and `added` of rank, start, stop, kind and hit.

    Null and empty texts have none; a null doc_id stays null; repeated rows are each scanned. Columns of those names are
    replaced, all others stay. Added spans share no place with a base span or with an added one of higher score.
    """
    plain = documents.select(F.struct(*(documents[name] for name in documents.columns)).alias("row"), spans.prepared(F.col("text")).alias("text"))
    text, gates = F.col("text"), F.col("gates")
    based = gated(plain, "text").withColumn("base", base_spans(text, gates))
    back = [F.col("row")[name].alias(name) for name in documents.columns if name not in ("base", "added")]
    open_kinds = {kind: least for kind, least in model.thresholds.items() if least < math.inf}
    if not open_kinds:
        return based.select(*back, "base", F.slice("base", 1, 0).alias("added"))
    free = F.filter(_proposed(text, gates), lambda span: span["kind"].isin(*open_kinds) & ~F.exists("base", lambda other: _overlap(span, other)))
    least = lambda kind: F.coalesce(*(F.when(kind == name, F.lit(value)) for name, value in open_kinds.items()))
    wanted = F.filter(
        F.transform(
            _described(text, F.col("free")),
            lambda span: F.struct((-model.score(span["x"])).alias("minus"), span["rank"], span["start"], span["stop"], span["kind"], span["hit"]),
        ),
        lambda span: _rounded(-span["minus"]) >= least(span["kind"]),
    )

    def keep(kept: Column, span: Column) -> Column:
        plain = F.struct(span["rank"], span["start"], span["stop"], span["kind"], span["hit"])
        return F.when(F.exists(kept, lambda other: _overlap(span, other)), kept).otherwise(F.array_append(kept, plain)).cast(spans.TAGGED)

    added = F.aggregate(F.array_sort(wanted), F.array().cast(spans.TAGGED), keep)
    return based.withColumn("free", free).select(*back, "base", added.alias("added"))


def _overlap(one: Column, other: Column) -> Column:
    return (one["start"] < other["stop"]) & (other["start"] < one["stop"])


def redact(found: DataFrame) -> DataFrame:
    """The texts of `find_personal_data` with every span replaced by its kind in brackets; null texts stay null.

    Where spans overlap, the one that starts first names the place, and the place reaches to the furthest end.
    """
    ordered = F.array_sort(F.transform(F.concat("base", "added"), lambda span: F.struct(span["start"], span["stop"], span["kind"])))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(state: Column, span: Column) -> Column:
        between = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        new = F.concat(state["out"], between, F.lit("["), span["kind"], F.lit("]"))
        inside = span["start"] < state["at"]
        return F.struct(
            F.when(inside, state["out"]).otherwise(new).alias("out"), F.greatest(state["at"], span["stop"]).alias("at")
        )

    whole = F.aggregate(ordered, start, step, lambda state: F.concat(state["out"], F.substring(F.col("text"), (state["at"] + 1).cast("int"), F.char_length("text"))))
    return found.withColumn("text", F.when(F.size(ordered) > 0, whole).otherwise(F.col("text"))).drop("base", "added")


def report(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans, by kind and then start."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_personal_data(narrow, fit_on(narrow)).drop("text")
    order = lambda column: F.array_sort(
        F.transform(column, lambda span: F.struct(span["rank"], span["start"], span["stop"], span["kind"]))
    )
    count = lambda kind: F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(kind) for kind in KINDS),
        spans.digest(spans.listed(order(F.col("base")))).alias("base_sha256"),
        spans.listed(order(F.concat("base", "added"))).alias("spans"),
    )
