"""The running flush rule: lines wait until their batch is full or their channel has been silent, then they are stored.

Each micro-batch takes the rows that still wait, numbers them together with the new ones, stores the batches that are
closed, and writes the rest as what waits next. What a channel carries on is one row of marks and less than one batch of
rows, in tables named by the micro-batch, so a micro-batch that is run again reads the same and replaces what it wrote.
The numbering spreads a channel over many sorted chunks, so a channel may hold any part of a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilcount.session import shared_folder
from veilcount.sinks.lake import BATCH_SIZE, IDLE_SECONDS, flush_batches

MARKS = "channel STRING, last_ts TIMESTAMP, session BIGINT, flush BIGINT, held BOOLEAN"
#: A stored batch: it gets the rows of closed flushes (the input's columns, session, flush) and the micro-batch's number.
Store = Callable[[DataFrame, int], None]


def _silent(since: Column, until: Column, idle_seconds: float) -> Column:
    return F.unix_micros(until) - F.unix_micros(since) > F.lit(int(idle_seconds * 1_000_000))


def flush_micro_batch(
    rows: DataFrame,
    number: int,
    folder: str,
    store: Store,
    idle_seconds: float = IDLE_SECONDS,
    batch_size: int = BATCH_SIZE,
    now: Column | None = None,
) -> None:
    """One micro-batch. ``rows`` has channel, ts and record_id, which orders rows of the same time, and any others.

    ``session`` and ``flush`` go on from the micro-batches before. The last flush of a channel stays open until it is full
    or its last row is more than ``idle_seconds`` before ``now``, which is the latest ts so far unless it is given. A row
    that comes late goes to the flush that is open; rows without channel or ts are left out.
    """
    spark = rows.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}/batch={number}")

    # Landed first: the sort below would read the source once more to find its ranges.
    new = written(rows.filter(F.col("channel").isNotNull() & F.col("ts").isNotNull()), "new")
    if number == 0:
        marks, waiting = spark.createDataFrame([], MARKS), new
    else:
        marks = spark.read.schema(MARKS).parquet(f"{folder}/marks/batch={number - 1}")
        waiting = new.unionByName(spark.read.schema(new.schema).parquet(f"{folder}/held/batch={number - 1}"))
    numbered = flush_batches(waiting, idle_seconds, batch_size).withColumnRenamed("batch", "flush")
    numbered = written(numbered.withColumnsRenamed({"session": "of_session", "flush": "of_flush"}), "numbered")

    # A channel goes on with its session if rows of it wait, or if the silence since its last row was short enough.
    firsts = numbered.groupBy("channel").agg(F.min("ts").alias("first_ts"))
    goes_on = F.col("held") | ~_silent(F.col("last_ts"), F.col("first_ts"), idle_seconds)
    zero = F.lit(0).cast("bigint")
    bases = firsts.join(marks, "channel", "left").select(
        "channel",
        F.when(F.col("last_ts").isNull(), zero).when(goes_on, F.col("session")).otherwise(F.col("session") + 1).alias("from_session"),
        F.when(F.col("last_ts").isNotNull() & goes_on, F.col("flush")).otherwise(zero).alias("from_flush"),
    )
    flushes = (
        numbered.groupBy("channel", "of_session", "of_flush")
        .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
        .join(bases, "channel")
        .select(
            "channel", "of_session", "of_flush", "n", "last_ts",
            (F.col("from_session") + F.col("of_session")).alias("session"),
            (F.col("of_flush") + F.when(F.col("of_session") == 0, F.col("from_flush")).otherwise(zero)).alias("flush"),
        )
    )
    flushes = written(flushes, "flushes")
    if now is None:
        latest = marks.select("last_ts").union(flushes.select("last_ts")).agg(F.max("last_ts")).first()[0]
        now = F.lit(latest).cast("timestamp")
    # One row a channel: its last flush, which alone can stay open.
    place = F.struct("session", "flush")
    tails = flushes.groupBy("channel").agg(
        F.max(place).alias("tail"), F.max_by("n", place).alias("n"), F.max_by("last_ts", place).alias("tail_ts"), F.max("last_ts").alias("last_ts")
    )
    held = (F.col("n") < batch_size) & ~_silent(F.col("tail_ts"), now, idle_seconds)
    tails = written(tails.select("channel", "tail", "last_ts", held.alias("held")), "tails")

    still_open = tails.filter("held").select("channel", F.col("tail.session").alias("session"), F.col("tail.flush").alias("flush"))
    named = numbered.join(flushes.drop("n", "last_ts"), ["channel", "of_session", "of_flush"]).drop("of_session", "of_flush")
    keys = ["channel", "session", "flush"]
    store(named.join(still_open, keys, "left_anti").select(*new.columns, "session", "flush"), number)
    written(named.join(still_open, keys, "left_semi").select(*new.columns), "held")
    after = tails.select(
        "channel", "last_ts", F.col("tail.session").alias("session"),
        (F.col("tail.flush") + F.when(F.col("held"), 0).otherwise(1)).alias("flush"), "held",
    )
    merged = after.unionByName(marks).groupBy("channel").agg(
        F.max("last_ts").alias("last_ts"), F.max(F.struct("session", "flush", "held")).alias("at")
    )
    written(merged.select("channel", "last_ts", "at.session", "at.flush", "at.held"), "marks")


def start_flushing_sink(
    lines: DataFrame,
    folder: str,
    checkpoint: str,
    store: Store,
    idle_seconds: float = IDLE_SECONDS,
    batch_size: int = BATCH_SIZE,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the flush rule on a stream with channel, ts and record_id. ``folder`` belongs to the checkpoint.

    Live, time is the clock's, and a slow stream of ticks runs the rule also while no line arrives. An available-now run
    takes the latest ts for the time, so what it closes depends on the rows alone.
    """
    spark = lines.sparkSession
    shared_folder(spark)
    if available_now:
        trigger, source, now = {"availableNow": True}, lines, None
    else:
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in lines.schema]
        trigger, source, now = {"processingTime": f"{idle_seconds} seconds"}, lines.unionByName(ticks.select(*empty)), F.current_timestamp()
    return (
        source.writeStream.foreachBatch(
            lambda rows, number: flush_micro_batch(rows, number, folder, store, idle_seconds, batch_size, now)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )

