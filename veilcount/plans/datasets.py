"""Measurement messages, records and logs derived from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilcount.functions.epochs import EpochLength, epoch_of_time
from veilcount.functions.text import base64_text

LINEITEM_ORIGIN = datetime(1995, 1, 1)
LINEITEM_EPOCH = EpochLength(days=728)
EVENT_ORIGIN = datetime(2024, 1, 1)
EVENT_EPOCH = EpochLength(days=7)
ORDER_ORIGIN = datetime(1995, 1, 1)
ORDER_EPOCH = EpochLength(months=1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its zone-less timestamps read as UTC instants."""
    return in_utc(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return in_utc(spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet"))


def in_utc(frame: DataFrame) -> DataFrame:
    zoneless = [f.name for f in frame.schema if f.dataType.typeName() == "timestamp_ntz"]
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else frame


def layer(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}|"), value.cast("string"))


def _two_classes(number: Column) -> Column:
    return F.when(number % 3 < 2, F.lit(20)).otherwise(F.lit(50)).alias("threshold")


def lineitem_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """epoch, layers, threshold; ``batch`` splits the messages by order number."""
    return table(spark, sf_dir, "lineitem").select(
        epoch_of_time(F.col("l_shipdate"), LINEITEM_ORIGIN, LINEITEM_EPOCH).alias("epoch"),
        F.array(
            layer("flag", F.col("l_returnflag")),
            layer("status", F.col("l_linestatus")),
            layer("disc", F.round(F.col("l_discount") * 100).cast("int")),
            layer("qty", F.floor(F.col("l_quantity") / 5).cast("int")),
        ).alias("layers"),
        _two_classes(F.col("l_suppkey")),
        (F.col("l_orderkey") % 3).cast("int").alias("batch"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of_events(table(spark, sf_dir, "events"))


def messages_of_events(events: DataFrame) -> DataFrame:
    """epoch, layers, threshold, msg_id, event_id, event_type, ts of the events table."""
    return events.select(
        epoch_of_time(F.col("ts"), EVENT_ORIGIN, EVENT_EPOCH).alias("epoch"),
        F.array(
            layer("type", F.col("event_type")),
            layer("hour", F.floor(F.hour("ts") / 6).cast("int")),
            layer("uid", F.col("user_id") % 8),
            layer("k", F.get_json_object("props", "$.k")),
        ).alias("layers"),
        _two_classes(F.col("event_id")),
        F.col("event_id").cast("string").alias("msg_id"),
        "event_id",
        "event_type",
        "ts",
    )


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """epoch by calendar month, layers and threshold of orders with their customer and nation."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        epoch_of_time(F.col("o_orderdate"), ORDER_ORIGIN, ORDER_EPOCH).alias("epoch"),
        F.array(
            layer("segment", F.col("c_mktsegment")),
            layer("nation", F.col("n_name")),
            layer("priority", F.col("o_orderpriority")),
            layer("status", F.col("o_orderstatus")),
        ).alias("layers"),
        _two_classes(F.col("o_custkey")),
        F.col("o_orderkey").cast("string").alias("msg_id"),
    )


# -- intake and records ------------------------------------------------------------------------------------------------

CHANNELS = {"click": 2, "view": None, "error": 5, "signup": 1, "purchase": 3}
MAIN_CHANNEL = "view"


def _envelope() -> Column:
    """A clear message as JSON text."""
    listed = F.concat(F.lit('["'), F.array_join("layers", '","'), F.lit('"]'))
    return F.concat(F.lit('{"epoch":'), F.col("epoch").cast("string"), F.lit(',"layers":'), listed, F.lit("}"))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submissions_of_events(table(spark, sf_dir, "events"))


def submissions_of_events(events: DataFrame) -> DataFrame:
    """Submissions of all events; some bodies, channels and headers are defective, depending on the event number."""
    number = F.col("event_id")
    text = (
        F.when(number % 43 == 2, F.expr("substring(envelope, 1, length(envelope) - 3)"))
        .when(number % 53 == 4, F.regexp_replace("envelope", '"epoch":[0-9]+', '"epoch":300'))
        .when(number % 59 == 6, F.lit('{"epoch":1}'))
        .otherwise(F.col("envelope"))
    )
    encoded = F.col("encoded")
    body = (
        F.when(number % 29 == 3, F.expr("substring(encoded, 1, length(encoded) - 1)").cast("binary"))
        .when(number % 31 == 5, F.concat(F.substring(encoded, 1, 8), F.lit("\n"), F.expr("substring(encoded, 9)")).cast("binary"))
        .when(number % 37 == 7, F.concat(F.unhex(F.lit("FF")), encoded.cast("binary")))
        .when(number % 41 == 1, F.concat(F.lit("  \n"), encoded, F.lit(" \t\r\n")).cast("binary"))
        .otherwise(encoded.cast("binary"))
    )
    channel = F.when(number % 47 == 0, F.lit("nosuch")).when(number % 5 != 0, F.col("event_type"))
    revision = (
        F.when(number % 7 == 1, F.lit("x"))
        .when(number % 7 == 2, F.lit("+4"))
        .when(number % 7 == 3, F.lit(" 12"))
        .when(number % 7 != 0, (number % 7).cast("string"))
    )
    threshold = F.when(number % 11 > 0, F.lit(None)).cast("string")
    for rest, value in ((1, "abc"), (2, "19"), (3, "51"), (4, "+20"), (5, "50"), (6, "30 ")):
        threshold = F.when(number % 11 == rest, F.lit(value)).otherwise(threshold)
    threshold = F.when(number % 11 > 6, (20 + number % 31).cast("string")).otherwise(threshold)
    rows = messages_of_events(events)
    return (
        rows.withColumn("envelope", _envelope())
        .withColumn("encoded", base64_text(text.cast("binary")))
        .select(
            "event_id",
            channel.alias("channel"),
            body.alias("body"),
            revision.alias("revision"),
            threshold.alias("threshold"),
            F.col("ts").alias("received_at"),
        )
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all events, shaped like Spark's Kafka source: four partitions, some headers odd or missing."""
    number = F.col("event_id")
    header = lambda key, digits: F.struct(F.lit(key).alias("key"), F.unhex(F.lit(digits)).alias("value"))
    headers = (
        F.when(number % 13 == 0, F.lit(None))
        .when(number % 13 == 1, F.array(header("threshold", "320000")))
        .when(number % 13 == 2, F.array(header("threshold", "14000000"), header("threshold", "32000000")))
        .when(number % 13 == 3, F.array(header("trace", "01000000")))
        .when(number % 13 == 4, F.array(header("threshold", "32010000"), header("trace", "00")))
        .otherwise(F.array(header("threshold", "14000000")))
    )
    return event_messages(spark, sf_dir).select(
        _envelope().cast("binary").alias("value"),
        headers.alias("headers"),
        (number % 4).cast("int").alias("partition"),
        F.floor(number / 4).alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def with_defective_layers(rows: DataFrame, number: Column) -> DataFrame:
    """Some messages with a second layer without a bar, a first with two, a last without a value."""
    at = lambda place: F.get("layers", F.lit(place))
    layers = (
        F.when(number % 17 == 0, F.array(at(0), F.replace(at(1), F.lit("|"), F.lit(" ")), at(2), at(3)))
        .when(number % 19 == 0, F.array(F.concat(at(0), F.lit("|x")), at(1), at(2), at(3)))
        .when(number % 23 == 0, F.array(at(0), at(1), at(2), F.lit("k")))
        .otherwise(F.col("layers"))
    )
    return rows.withColumn("layers", layers)


def with_defects(records: DataFrame) -> DataFrame:
    """Records whose messages have some defective layers, by event number."""
    parsed = records.withColumn("m", F.from_json(F.col("value").cast("string"), "epoch INT, layers ARRAY<STRING>"))
    spread = parsed.withColumns({"epoch": F.col("m.epoch"), "layers": F.col("m.layers")})
    defective = with_defective_layers(spread, F.col("offset") * 4 + F.col("partition"))
    return defective.withColumn("value", _envelope().cast("binary")).drop("m", "epoch", "layers")


# -- logs --------------------------------------------------------------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    status = F.when(number % 19 == 0, 404).when(number % 23 == 0, 400).otherwise(204)
    return table(spark, sf_dir, "events").select(
        F.lit("POST").alias("method"),
        F.concat(F.lit("/"), "event_type").alias("path"),
        epoch_of_time(F.col("ts"), EVENT_ORIGIN, EVENT_EPOCH).alias("epoch"),
        status.alias("status"),
        (F.col("value") / 100).alias("seconds"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stat"), F.round(F.col("value") * 100).cast("bigint").alias("ms")
    )


COMMITTED_AT = "2024-01-28 06:00:00"


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High and committed offsets per channel and partition: events so far, and those before a cut-off time.

    Partition 3 has nothing committed.
    """
    read = F.col("ts") < F.lit(COMMITTED_AT).cast("timestamp")
    counted = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("channel"), (F.col("user_id") % 4).cast("int").alias("partition"))
        .agg(F.count(F.lit(1)).alias("high"), F.count_if(read).alias("read"))
    )
    return counted.withColumn("committed", F.when(F.col("partition") < 3, F.col("read"))).drop("read")


def lake_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("channel"), "ts", F.col("event_id").alias("record_id")
    )
