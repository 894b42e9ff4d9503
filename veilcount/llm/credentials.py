"""Secret scans with multipart credential linking, with built-in functions only.

Some parts of a credential tell by themselves (assignments, access keys, long hex); they are always reported. Others are
weak: names of accounts, tokens of mixed signs, addresses of services. Parts are identifiers, secrets or endpoints; a weak
one is reported only where a complementary part, strong or weak, lies within `REACH` code points in the same text. All
parts become rows and are joined as intervals: equal text and bin, one side reaching into the bins around it, then the
distance. A bin of a text holds few parts, whatever the text's length, so no key of this join can grow hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilcount.llm import spans
from veilcount.session import new_work_folder

REACH = 300
_BIN = 512

#: The base kinds in their order, with their patterns.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")
#: Weak kinds, their part and their patterns.
WEAK = (
    (
        "account",
        "identifier",
        r"""(?i:client_?id|user_?name|user|login|account|access_?key_?id|tenant)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
    ),
    (
        "opaque",
        "secret",
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=a-z-]*+[A-Z])(?=[0-9+/_=A-Z-]*+[a-z])[A-Za-z0-9+/_=-]{20,}",
    ),
    (
        "endpoint",
        "endpoint",
        r"(?i:https?|s3|gs|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9.-]+(?::[0-9]+)?",
    ),
)
_PART = {"assign": "secret", "hex": "secret", "access": "identifier"} | {kind: part for kind, part, _ in WEAK}
_RANK = {kind: rank for rank, kind in enumerate((*KINDS, *(kind for kind, _, _ in WEAK)))}


def _base(text: Column) -> list[Column]:
    value = lambda hit: F.regexp_extract(hit, ASSIGN, 1)
    return [
        spans.tagged(F.filter(spans.find(text, ASSIGN), lambda span: F.char_length(value(span["hit"])) >= 6), "assign", 0),
        spans.tagged(spans.find(text, ACCESS), "access", 1),
        spans.tagged(spans.find(text, HEX), "hex", 2),
    ]


def _outside(weak: Column, strong: Column) -> Column:
    """Weak spans that share no place with a strong one."""
    return F.filter(
        weak, lambda span: ~F.exists(strong, lambda other: (other["start"] < span["stop"]) & (span["start"] < other["stop"]))
    )


def find_parts(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, and the arrays `strong` and `weak` of every row; the hits themselves are left out."""
    text = spans.prepared(F.col("text"))
    plain = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("text_key"), text.alias("text")
    )
    found = plain.select(
        "doc_id",
        "text_key",
        F.concat(*_base(F.col("text"))).alias("strong"),
        F.concat(*(spans.tagged(spans.find(F.col("text"), pattern), kind, _RANK[kind]) for kind, _, pattern in WEAK)).alias("weak"),
    )
    narrow = lambda column: F.transform(column, lambda span: span.dropFields("hit"))
    return found.select("doc_id", "text_key", narrow(F.col("strong")).alias("strong"), narrow(_outside(F.col("weak"), F.col("strong"))).alias("weak"))


def _bins(start: Column, stop: Column) -> Column:
    return F.sequence(F.floor(start / _BIN), F.floor(stop / _BIN))


def link_parts(found: DataFrame) -> DataFrame:
    """text_key and the array `linked`: the weak spans that have a complementary part within reach. One row per text."""
    part = F.element_at(F.create_map(*(F.lit(word) for pair in _PART.items() for word in pair)), F.col("span.kind"))
    # Texts without a weak part link nothing; equal texts are linked once.
    texts = found.where(F.size("weak") > 0).groupBy("text_key").agg(F.first("strong").alias("strong"), F.first("weak").alias("weak"))
    rows = lambda column: texts.select("text_key", F.explode(column).alias("span")).withColumn("part", part)
    weak = rows(F.col("weak")).withColumn("bin", F.explode(_bins(F.col("span.start"), F.col("span.stop"))))
    near = rows(F.concat("strong", "weak")).select(
        "text_key",
        F.explode(_bins(F.col("span.start") - REACH, F.col("span.stop") + REACH)).alias("bin"),
        F.col("span").alias("other"),
        F.col("part").alias("other_part"),
    )
    complementary = (
        (F.col("part") != F.col("other_part"))
        & (F.col("other.start") <= F.col("span.stop") + REACH)
        & (F.col("span.start") <= F.col("other.stop") + REACH)
        & ((F.col("part") == "secret") | (F.col("other_part") == "secret"))
    )
    left, right = weak.alias("l"), near.alias("r")
    on = (F.col("l.text_key") == F.col("r.text_key")) & (F.col("l.bin") == F.col("r.bin")) & complementary
    linked = left.join(right, on, "left_semi")
    return linked.groupBy("text_key").agg(F.array_sort(F.collect_set("span")).alias("linked"))


def scan_secrets(documents: DataFrame) -> DataFrame:
    """doc_id, and the arrays `strong` and `linked` of kind, start and stop, for every row of `documents` (doc_id, text).

    Null and empty texts have no spans; a null doc_id stays null; repeated rows and equal texts get equal spans; other
    columns are ignored. Spans of one kind never overlap, those of different kinds may.
    """
    spark = documents.sparkSession
    folder = new_work_folder(spark, "credential-parts")
    find_parts(documents).write.parquet(folder)
    found = spark.read.parquet(folder)
    linked = link_parts(found)
    none = F.array().cast(found.schema["weak"].dataType)
    return found.join(linked, "text_key", "left").select("doc_id", "strong", F.coalesce("linked", none).alias("linked"))


def report(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans, by start and then kind."""
    order = lambda column: F.array_sort(
        F.transform(column, lambda span: F.struct(span["start"], span["rank"], span["stop"], span["kind"]))
    )
    count = lambda kind: F.size(F.filter("strong", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan_secrets(documents).select(
        "doc_id",
        *(count(kind) for kind in KINDS),
        spans.digest(spans.listed(order(F.col("strong")))).alias("base_sha256"),
        spans.listed(order(F.concat("strong", "linked"))).alias("spans"),
    )
