"""Operational summaries over log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Reported percentiles and the upper bounds of the latency buckets in seconds.
PERCENTILES = (0.5, 0.75, 0.9, 0.99)
LATENCY_BOUNDS = (0.01, 0.02, 0.04, 0.08, 0.16, 0.32, 0.64, 1.28)

_DIGIT = 65_536


def timing_summary(timings: DataFrame) -> DataFrame:
    """min, percentiles, max, sum and count of ``ms`` per ``stat``; a percentile p is sorted[floor(n * p)].

    Equal values are counted first. Ranks come from sums over the high 16 bits of a value and then over the low 16, so
    no window holds more than 65 536 rows, however many timings a stat has.
    """
    counted = timings.groupBy("stat", F.col("ms").cast("bigint").alias("ms")).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("high", F.floor(F.col("ms") / _DIGIT))
    coarse = counted.groupBy("stat", "high").agg(F.sum("n").alias("n"))
    by_high = Window.partitionBy("stat").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("stat")
    zero = F.lit(0).cast("bigint")
    placed = coarse.select(
        "stat",
        "high",
        F.coalesce(F.sum("n").over(by_high), zero).alias("before_high"),
        F.sum("n").over(whole).alias("of_stat"),
    )
    by_low = Window.partitionBy("stat", "high").orderBy("ms").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        counted.withColumn("before_low", F.coalesce(F.sum("n").over(by_low), zero))
        .join(placed, ["stat", "high"])
        .withColumn("before", F.col("before_high") + F.col("before_low"))
    )

    def at(p: float) -> Column:
        index = F.floor(F.col("of_stat").cast("float") * F.lit(p).cast("float"))
        holds = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
        return F.max(F.when(holds, F.col("ms"))).alias(f"p{round(p * 100)}")

    return ranked.groupBy("stat").agg(
        F.min("ms").alias("min"),
        *[at(p) for p in PERCENTILES],
        F.max("ms").alias("max"),
        F.sum(F.col("ms") * F.col("n")).alias("sum"),
        F.sum("n").alias("count"),
    )


def request_counts(requests: DataFrame) -> DataFrame:
    """Requests by method, path, epoch and status; unknown paths (404) are left out."""
    known = requests.filter(F.col("status") != 404)
    return known.groupBy("method", "path", "epoch", "status").agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(requests: DataFrame) -> DataFrame:
    """Cumulative latency buckets by method, path and status, with sum (in microseconds) and count."""
    names = [str(b) for b in LATENCY_BOUNDS]
    counts = requests.filter(F.col("status") != 404).groupBy("method", "path", "status").agg(
        *[F.count_if(F.col("seconds") <= F.lit(b)).alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)],
        F.count(F.lit(1)).alias("count"),
        F.sum(F.round(F.col("seconds") * 1_000_000).cast("bigint")).alias("sum_micros"),
    )
    buckets = [F.struct(F.lit(n).alias("le"), F.col(f"le_{i}").alias("requests")) for i, n in enumerate(names)]
    buckets.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("requests")))
    return counts.select("method", "path", "status", "count", "sum_micros", F.inline(F.array(*buckets)))


def lake_progress(batches: DataFrame, now: Column, idle_seconds: float, batch_size: int) -> DataFrame:
    """Records saved and records received but not saved yet, per channel.

    ``batches`` has channel, session, batch and ts per record. A batch is saved when it is full, when a later one
    exists, or when its channel has been silent for longer than ``idle_seconds``.
    """
    sizes = batches.groupBy("channel", "session", "batch").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    newest = sizes.groupBy("channel").agg(F.max(F.struct("session", "batch")).alias("newest"))
    silent = F.unix_micros(now) - F.unix_micros("last") > F.lit(int(idle_seconds * 1_000_000))
    open_batch = (F.struct("session", "batch") == F.col("newest")) & (F.col("n") < batch_size) & ~silent
    marked = sizes.join(newest, "channel").withColumn("open", open_batch)
    return marked.groupBy("channel").agg(
        F.sum(F.when(~F.col("open"), F.col("n")).otherwise(0)).alias("saved"),
        F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("waiting"),
    )


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Unread records per channel; partitions without a committed offset do not count."""
    lag = F.when(F.col("committed").isNotNull(), F.col("high") - F.col("committed")).otherwise(0)
    return offsets.groupBy("channel").agg(F.sum(lag).alias("lag"))


def stream_progress(progress: DataFrame, stored: DataFrame) -> DataFrame:
    """Records received by each stream from its landed progress, those it has stored (name, saved), and those that wait."""
    received = progress.groupBy("name").agg(F.sum("records").alias("received"))
    saved = F.coalesce("saved", F.lit(0).cast("bigint"))
    return received.join(stored, "name", "left").select("name", "received", saved.alias("saved"), (F.col("received") - saved).alias("waiting"))


def stream_lag(progress: DataFrame) -> DataFrame:
    """Records at the source that the last micro-batch of each stream had not reached, per name and topic.

    Offsets are the JSON texts of a topic source; partitions that the stream has not begun count from offset 0.
    """
    newest = progress.groupBy("name", "source").agg(F.max_by(F.struct("end_offset", "latest_offset"), "batch").alias("p"))
    parts = "map<string,map<string,bigint>>"
    read = newest.select(
        "name", F.from_json("p.end_offset", parts).alias("ends"), F.explode(F.from_json("p.latest_offset", parts)).alias("topic", "latest")
    )
    rows = read.select("name", "topic", F.explode("latest").alias("partition", "high"), F.try_element_at("ends", "topic").alias("ends"))
    behind = F.col("high") - F.coalesce(F.try_element_at("ends", "partition"), F.lit(0))
    return rows.groupBy("name", "topic").agg(F.sum(F.greatest(behind, F.lit(0))).alias("lag"))


def channels_due(lag: DataFrame, channels: DataFrame, now: Column) -> DataFrame:
    """Channels with enough lag whose lock-out after the last success, if any, is over.

    ``channels``: channel, lag_threshold, last_success, min_seconds.
    """
    free_at = F.unix_micros("last_success") + F.col("min_seconds") * 1_000_000
    unlocked = F.col("last_success").isNull() | (F.unix_micros(now) >= free_at)
    due = (F.col("lag") >= F.col("lag_threshold")) & unlocked
    return lag.join(channels, "channel").select("channel", "lag", due.alias("due"))
