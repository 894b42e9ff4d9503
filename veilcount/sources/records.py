"""Records of the encrypted topic: reading, thresholds, bounded batches, arrival rates.

A record has the columns of Spark's Kafka source with headers: value, headers, partition, offset, timestamp. The same
functions work on a landed table of that shape.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from veilcount.functions.conditions import any_of
from veilcount.functions.once import once
from veilcount.functions.text import headers_named, little_endian_u32
from veilcount.session import new_work_folder
from veilcount.sources.intake import CLEAR_ENVELOPE, parse_envelope

# The defaults of an aggregation run.
DEFAULT_THRESHOLD = 50
MAX_MESSAGES = 650_000
MAX_ITERATIONS = 3
MIN_MESSAGES = 1_000
FRAME_SECONDS = 5
MIN_RATE = 100


def topic_options(servers: str, topic: str, starts: dict[int, int] | None, ends: dict[int, int] | None) -> dict[str, str]:
    """Options of Spark's Kafka reader for a range of offsets; None reads from the earliest or to the latest record.

    A partition that ``starts`` does not name is read from its earliest record on.
    """

    def listed(offsets: dict[int, int] | None, other: str) -> str:
        if offsets is None:
            return other
        return json.dumps({topic: {str(partition): offset for partition, offset in sorted(offsets.items())}})

    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": listed(starts, "earliest"),
        "endingOffsets": listed(ends, "latest"),
        "kafka.isolation.level": "read_committed",
        "includeHeaders": "true",
    }


def stream_options(servers: str, topic: str, limit: int | None = MAX_MESSAGES) -> dict[str, str]:
    """Options of Spark's Kafka stream, which reads on from its checkpoint, or from the earliest record without one.

    The source deals the limit to the partitions by what waits in each, and fixes the end of a batch from metadata.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "includeHeaders": "true",
    }
    return options if limit is None else {**options, "maxOffsetsPerTrigger": str(limit)}


def end_offset(stream: DataFrame) -> str | None:
    """Where the source of a stream ends now, as its own JSON text; None if it holds nothing.

    An available-now query asks the source for its end, and takes nothing from the batch, so no record is read.
    """
    checkpoint = new_work_folder(stream.sparkSession, "end")
    query = stream.writeStream.foreachBatch(lambda rows, number: None).option("checkpointLocation", checkpoint)
    asked = query.trigger(availableNow=True).start()
    asked.awaitTermination()
    found = asked.lastProgress
    return found["sources"][0]["endOffset"] if found else None


def topic_ends(offset: str | dict | None, topic: str) -> dict[int, int]:
    """End offsets by partition from a topic's offset JSON."""
    ends = json.loads(offset) if isinstance(offset, str) else offset or {}
    return {int(partition): end for partition, end in (ends.get(topic) or {}).items()}


def waiting_known(ends: dict[int, int], committed: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """Rows of ``extent`` for the partitions with a committed offset, from offsets alone.

    A compacted or transactional topic has gaps, so the number of messages is an upper bound.
    """
    return [(p, end - committed[p], committed[p], end) for p, end in sorted(ends.items()) if end > committed.get(p, end)]


@dataclass(frozen=True)
class Topic:
    """A topic as the source of a run; progress is kept by the job, not by a consumer group."""

    spark: SparkSession
    servers: str
    name: str

    def _read(self, starts: dict[int, int] | None, ends: dict[int, int] | None) -> DataFrame:
        options = topic_options(self.servers, self.name, starts, ends)
        return self.spark.read.format("kafka").options(**options).load()

    def waiting(self, committed: dict[int, int]) -> DataFrame:
        """Extent of what is not read yet. Ends come from the broker's metadata, new partitions included.

        Only partitions without a committed offset are read, to find their first record; the range of the others is empty.
        """
        ends = topic_ends(end_offset(self.stream(None)), self.name)
        known = self.spark.createDataFrame(waiting_known(ends, committed), EXTENT)
        if ends.keys() <= committed.keys():
            return known
        starts = {partition: end if partition in committed else EARLIEST for partition, end in ends.items()}
        return known.unionByName(extent(self._read(starts, ends)))

    def stream(self, limit: int | None = MAX_MESSAGES) -> DataFrame:
        """The topic as a stream of micro-batches of at most so many records."""
        loaded = self.spark.readStream.format("kafka").options(**stream_options(self.servers, self.name, limit)).load()
        return loaded.select("value", "headers", "partition", "offset", "timestamp")

    def between(self, starts: dict[int, int], ends: dict[int, int]) -> DataFrame:
        return self._read(starts, ends).select("value", "headers", "partition", "offset", "timestamp")


@dataclass(frozen=True)
class Landed:
    """A landed table of records as the source of a run."""

    records: DataFrame

    def waiting(self, committed: dict[int, int]) -> DataFrame:
        return extent(after(self.records, committed))

    def between(self, starts: dict[int, int], ends: dict[int, int]) -> DataFrame:
        return self.records.filter(in_ranges({p: (starts[p], ends[p]) for p in starts}))


# Fixed value: the offset that Spark's Kafka reader takes for the earliest record.
EARLIEST = -2

EXTENT = "partition INT, messages BIGINT, first BIGINT, next_offset BIGINT"


def in_ranges(ranges: dict[int, tuple[int, int]]) -> Column:
    """Offsets from first to before last, by partition, as plain comparisons that reach the scan."""
    alike: dict[tuple[int, int], list[int]] = {}
    for partition, bounds in sorted(ranges.items()):
        alike.setdefault(bounds, []).append(partition)
    tests = [
        F.col("partition").isin(partitions) & (F.col("offset") >= first) & (F.col("offset") < last)
        for (first, last), partitions in alike.items()
        if first < last
    ]
    return any_of(tests)


def after(records: DataFrame, committed: dict[int, int]) -> DataFrame:
    """Records that are not committed yet; a partition without a committed offset starts at its earliest record."""
    if not committed:
        return records
    known: dict[int, list[int]] = {}
    for partition, offset in sorted(committed.items()):
        known.setdefault(offset, []).append(partition)
    tests = [F.col("partition").isin(partitions) & (F.col("offset") >= offset) for offset, partitions in known.items()]
    return records.filter(any_of([~F.col("partition").isin(list(committed)), *tests]))


def extent(records: DataFrame) -> DataFrame:
    """Per partition: messages, the first offset there is, and the offset after the last."""
    return records.groupBy(F.col("partition").cast("int").alias("partition")).agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first"), (F.max("offset") + 1).alias("next_offset")
    )


def shares(sizes: dict[int, int], limit: int) -> dict[int, int]:
    """``limit`` dealt to the partitions evenly; what a small one leaves goes to those with more.

    The sum is the limit, or everything if that is less.
    """
    dealt, left = {}, limit
    for at, (partition, size) in enumerate(sorted(sizes.items(), key=lambda item: (item[1], item[0]))):
        dealt[partition] = min(size, left // (len(sizes) - at))
        left -= dealt[partition]
    return dealt


def batch_ends(waiting: list[Row], limit: int) -> tuple[dict[int, int], dict[int, int]]:
    """First and end offsets of the next batch from the rows of ``extent``, one per partition with waiting records.

    A share counts offsets from the first record there is, so a gap before it costs nothing, and a gap behind it makes
    the batch smaller but never empty.
    """
    dealt = shares({row.partition: row.next_offset - row["first"] for row in waiting}, max(limit, len(waiting)))
    starts = {row.partition: row["first"] for row in waiting}
    return starts, {partition: first + dealt[partition] for partition, first in starts.items()}


def bounded_batch(source: Topic | Landed, committed: dict[int, int], limit: int = MAX_MESSAGES) -> Batch:
    """The next at most ``limit`` records. Its end is fixed here, before anything is read."""
    waiting = source.waiting(committed).collect()  # one row per partition
    starts, ends = batch_ends(waiting, limit)
    return Batch(source.between(starts, ends), sum(row.messages for row in waiting), committed | ends)


@dataclass(frozen=True)
class Batch:
    """Records of a batch, how many were waiting when it was cut, and the offsets to read after it."""

    records: DataFrame
    waiting: int
    next_offsets: dict[int, int]


def with_threshold(records: DataFrame, default: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Threshold of each record: its last header, 0 if that is not four bytes, the default if there is none."""
    number = once(
        headers_named(F.col("headers"), "threshold"),
        lambda found: F.when(F.size(found) > 0, little_endian_u32(F.try_element_at(found, F.lit(-1))["value"])),
    )
    return records.withColumn("threshold", F.coalesce(number, F.lit(default).cast("bigint")))


def alike(records: DataFrame) -> DataFrame:
    """Records of equal value and headers as one row with their number ``n`` and the place of one of them.

    What follows is parsed once for each such row, by as many tasks as the shuffle has, however few tasks read the records.
    """
    first = [F.first(name).alias(name) for name in ("partition", "offset")]  # both of the same record
    return records.groupBy("value", "headers").agg(F.count(F.lit(1)).alias("n"), *first)


def to_messages(
    records: DataFrame, schema: str = CLEAR_ENVELOPE, mode: str = "failfast", default: int = DEFAULT_THRESHOLD
) -> DataFrame:
    """Parsed messages with their thresholds.

    ``failfast`` stops the job at a record that does not parse; ``quarantine`` keeps such rows with a NULL message.
    """
    parsed = with_threshold(records, default).withColumn("message", parse_envelope(F.col("value"), schema))
    if mode == "quarantine":
        return parsed
    if mode != "failfast":
        raise ValueError(f"unknown mode {mode!r}")
    problem = F.concat(F.lit("record does not parse: partition "), F.col("partition"), F.lit(" offset "), F.col("offset"))
    checked = F.when(F.col("message").isNull(), F.raise_error(problem)).otherwise(F.col("message"))
    return parsed.withColumn("message", checked)


def arrival_rate(
    records: DataFrame, frame_seconds: int = FRAME_SECONDS, ticks: int = FRAME_SECONDS, min_rate: int = MIN_RATE
) -> DataFrame:
    """Messages per time frame, empty frames included; a frame is low if floor(messages / ticks) < min_rate.

    ``ticks`` is the number of rate units in a frame, which is its seconds unless the clock is scaled.
    """
    number = F.floor(F.unix_micros("timestamp") / F.lit(frame_seconds * 1_000_000))
    counts = records.groupBy(number.alias("frame")).agg(F.count(F.lit(1)).alias("messages"))
    first, last = counts.agg(F.min("frame"), F.max("frame")).first()
    frames = records.sparkSession.range(first or 0, 0 if last is None else last + 1).select(F.col("id").alias("frame"))
    filled = frames.join(counts, "frame", "left").withColumn("messages", F.coalesce("messages", F.lit(0).cast("bigint")))
    return filled.select(
        F.timestamp_seconds(F.col("frame") * frame_seconds).alias("start"),
        "messages",
        (F.floor(F.col("messages") / ticks) < min_rate).alias("low"),
    )
