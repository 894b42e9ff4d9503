"""Submissions to records: decode, parse, route and classify in one projection.

A submission has ``channel`` (NULL for the main path), ``body`` (bytes), ``revision`` and ``threshold`` (header texts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilcount.functions.once import once
from veilcount.functions.text import strict_base64, trimmed_utf8, unsigned_header

# Accepted request thresholds and the response codes.
MIN_REQUEST_THRESHOLD = 20
MAX_REQUEST_THRESHOLD = 50
NOT_FOUND, BAD_REQUEST, NO_CONTENT = 404, 400, 204

MAX_BROADCAST = 10_000

CLEAR_ENVELOPE = "epoch INT, layers ARRAY<STRING>"
SEALED_ENVELOPE = "epoch INT, msg_id STRING, tag STRING, x BIGINT, y ARRAY<BIGINT>, ct STRING, inner STRING"


@dataclass(frozen=True)
class Channel:
    name: str
    min_revision: int | None = None


def channel_table(spark: SparkSession, channels: list[Channel]) -> DataFrame:
    """The channel settings as a table. Their number is known here: few are broadcast, many are left to Spark's choice."""
    table = spark.createDataFrame([(c.name, c.min_revision) for c in channels], "channel STRING, min_revision BIGINT")
    return F.broadcast(table) if len(channels) <= MAX_BROADCAST else table


def route(submissions: DataFrame, channels: DataFrame, main_channel: str) -> DataFrame:
    """Resolve the channel; ``known`` is false for a channel without settings."""
    resolved = submissions.withColumn("channel", F.coalesce("channel", F.lit(main_channel)))
    return resolved.join(channels.withColumn("known", F.lit(True)), "channel", "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def decode_body(submissions: DataFrame) -> DataFrame:
    """Add ``text`` (NULL if not UTF-8) and ``data`` (NULL if not strict base64)."""
    return submissions.withColumn("text", trimmed_utf8(F.col("body"))).withColumn(
        "data", strict_base64(F.col("text"))
    )


def parse_envelope(data: Column, schema: str = CLEAR_ENVELOPE) -> Column:
    """The message struct in the bytes, NULL unless all of it is valid."""
    text = F.try_validate_utf8(data.cast("string"))
    parsed = F.from_json(text, f"{schema}, broken STRING", {"columnNameOfCorruptRecord": "broken"})

    def checked(message: Column) -> Column:
        valid = message["broken"].isNull() & message["epoch"].between(0, 255)
        if schema == CLEAR_ENVELOPE:
            valid &= (F.size(message["layers"]) > 0) & ~F.exists(message["layers"], lambda c: c.isNull())
        else:
            for field in ("msg_id", "tag", "x", "y", "ct"):
                valid &= message[field].isNotNull()
        return F.when(F.coalesce(valid, F.lit(False)), message.dropFields("broken"))

    return once(parsed, checked)


def old_client(revision: Column, min_revision: Column) -> Column:
    """True for clients below the channel's minimum; a missing or unreadable revision counts as 0."""
    given = F.coalesce(unsigned_header(revision), F.lit(0).cast("decimal(38,0)"))
    return F.coalesce(given < min_revision, F.lit(False))


def bad_threshold(threshold: Column, low: int = MIN_REQUEST_THRESHOLD, high: int = MAX_REQUEST_THRESHOLD) -> Column:
    """True for a readable threshold outside the range; a missing or unreadable one is no threshold."""
    number = unsigned_header(threshold)
    return F.coalesce(~number.between(low, high), F.lit(False))


def classify(
    submissions: DataFrame,
    channels: DataFrame,
    main_channel: str,
    schema: str = CLEAR_ENVELOPE,
    low: int = MIN_REQUEST_THRESHOLD,
    high: int = MAX_REQUEST_THRESHOLD,
) -> DataFrame:
    """Add ``status``, ``accepted``, ``message`` and ``request_threshold``; the checks apply in this order."""
    checked = decode_body(route(submissions, channels, main_channel)).withColumn(
        "message", parse_envelope(F.col("data"), schema)
    )
    outcome = (
        F.when(~F.col("known"), "unknown")
        .when(F.col("message").isNull(), "malformed")
        .when(old_client(F.col("revision"), F.col("min_revision")), "ignored")
        .when(bad_threshold(F.col("threshold"), low, high), "bad_threshold")
        .otherwise("accepted")
    )
    status = (
        F.when(F.col("outcome") == "unknown", NOT_FOUND)
        .when(F.col("outcome").isin("malformed", "bad_threshold"), BAD_REQUEST)
        .otherwise(NO_CONTENT)
    )
    return checked.withColumn("outcome", outcome).withColumns(
        {
            "status": status,
            "accepted": F.col("outcome") == "accepted",
            "request_threshold": unsigned_header(F.col("threshold")).cast("bigint"),
        }
    )


def to_records(classified: DataFrame) -> DataFrame:
    """Accepted submissions as records: the original bytes, and the threshold as a little-endian header.

    Only an accepted submission makes a record, as the one element of an array; a plain filter on the outcome would be
    pushed below it, and every body be decoded and parsed twice.
    """
    accepted = F.when(F.col("accepted"), F.array(F.struct("channel", "data", "request_threshold")))
    kept = classified.select(F.inline(accepted))
    digits = F.lpad(F.hex("request_threshold"), 8, "0")
    little = F.unhex(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]))
    header = F.struct(F.lit("threshold").alias("key"), little.alias("value"))
    headers = F.when(F.col("request_threshold").isNotNull(), F.array(header))
    return kept.select("channel", F.col("data").alias("value"), headers.alias("headers"))
