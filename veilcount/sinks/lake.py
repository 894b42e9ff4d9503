"""The JSON-lines lake: dated and channelled text files, batching, the date field, and reading back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilcount.operators.ordering import ordered_chunks, running_sum, with_previous

# The flush rules and the name of the date field.
BATCH_SIZE = 1_000
IDLE_SECONDS = 45
DATE_FIELD = "ymd"


def with_date_field(lines: DataFrame, date: Column, channels: list[str]) -> DataFrame:
    """For the listed channels: set the date field in JSON objects, drop blank lines, fail on broken JSON.

    Other JSON values pass unchanged, and so do all lines of other channels. Where a key is repeated, the last value
    counts; that takes ``spark.sql.variant.allowDuplicateKeys``, which ``build_session`` sets.
    """
    listed = F.col("channel").isin(channels)
    parsed = F.try_parse_json("line")
    fields = F.map_filter(parsed.try_cast("map<string,variant>"), lambda k, _: k != F.lit(DATE_FIELD))
    dated = F.to_json(F.map_concat(fields, F.create_map(F.lit(DATE_FIELD), date.cast("string").cast("variant"))))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    rewritten = (
        F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("not JSON: "), F.substring("line", 1, 100))))
        .when(is_object, dated)
        .otherwise(F.to_json(parsed))
    )
    kept = lines.filter(~listed | F.col("line").rlike(r"(?U)\S"))
    return kept.withColumn("line", F.when(listed, rewritten).otherwise(F.col("line")))


def measurement_lines(measurements: DataFrame, channel: str) -> DataFrame:
    """(channel, line) of a run's measurements, as the lake takes them."""
    return measurements.select(F.lit(channel).alias("channel"), F.col("json").alias("line"))


def topic_writer_options(servers: str, topic: str) -> dict[str, str]:
    """Options of Spark's Kafka writer for measurement lines."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def topic_records(measurements: DataFrame, run: str) -> DataFrame:
    """(key, value) of measurements as records of a topic, one JSON text each.

    A key names the run, the batch, the text and the place among equal rows of the batch. A batch that is written again
    has the same keys, in whatever order its rows come, so readers can tell repeats from equal measurements.
    """
    same = ["batch", "epoch", "is_partial", "json"]
    rows = measurements.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    placed = rows.withColumn("place", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    named = [F.lit(run), "batch", "epoch", "is_partial", F.sha2(F.col("json"), 256), "place"]
    key = F.concat_ws("/", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in named])
    return placed.select(key.cast("binary").alias("key"), F.col("json").cast("binary").alias("value"))


def kept_once(records: DataFrame) -> DataFrame:
    """One record of each key; records without a key all stay."""
    return records.filter(F.col("key").isNotNull()).dropDuplicates(["key"]).unionByName(records.filter(F.col("key").isNull()))


def write_topic(measurements: DataFrame, servers: str, topic: str, run: str) -> None:
    """Measurements to a topic. Delivery is at least once, as Spark's writer has it; ``kept_once`` drops the repeats."""
    rows = topic_records(measurements, run)
    rows.write.format("kafka").options(**topic_writer_options(servers, topic)).save()


def write_jsonl(lines: DataFrame, folder: str, date: Column, max_records: int = BATCH_SIZE, mode: str = "append") -> None:
    """Lines as text files below date=.../channel=...; one file holds at most ``max_records`` lines."""
    (
        lines.select(date.cast("string").alias("date"), "channel", F.col("line").alias("value"))
        .write.mode(mode)
        .partitionBy("date", "channel")
        .option("maxRecordsPerFile", max_records)
        .text(folder)
    )


def read_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """(date, channel, line) of the lake."""
    return (
        spark.read.schema("value STRING, date STRING, channel STRING").text(folder)
        .select("date", "channel", F.col("value").alias("line"))
    )


def flush_batches(
    records: DataFrame, idle_seconds: float = IDLE_SECONDS, batch_size: int = BATCH_SIZE, chunks: int | None = None
) -> DataFrame:
    """Number the lake batches of each channel: a batch ends when full or after more than ``idle_seconds`` of silence.

    ``records`` has channel, ts and record_id, which orders records of the same time. Adds ``session`` (0 for the
    first) and ``batch`` within the session. A channel is spread over many sorted chunks, and only a few sums per
    chunk pass from one chunk to the next.
    """
    chunked = ordered_chunks(records, ["channel", "ts", "record_id"], chunks)
    order = ["ts", "record_id"]
    gaps = with_previous(chunked, ["channel"], order, "ts", "previous_ts")
    silence = F.unix_micros("ts") - F.unix_micros("previous_ts")
    starts = F.when(silence > F.lit(int(idle_seconds * 1_000_000)), 1).otherwise(0).cast("bigint")
    # Every step is read twice, for the rows and for the sums of its chunks.
    started = gaps.withColumn("starts", starts).checkpoint()
    numbered = running_sum(started, ["channel"], order, F.col("starts"), "session").checkpoint()
    placed = running_sum(numbered, ["channel", "session"], order, F.lit(1).cast("bigint"), "place")
    return placed.withColumn("batch", F.floor((F.col("place") - 1) / batch_size)).drop("place", "starts", "previous_ts", "chunk")


def rollup(measurements: DataFrame, dimensions: list[str]) -> DataFrame:
    """Sum the totals: a chain is reported again with each run that adds messages to it."""
    return measurements.groupBy(*dimensions).agg(F.sum("total").alias("total"), F.count(F.lit(1)).alias("reports"))
