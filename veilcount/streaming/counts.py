"""The threshold aggregation as a stateful stream: class counts live in the state store, with an expiry by epoch.

A trigger updates the classes that its messages touch and lands their new counts. What is revealed at any time is a query
over the landed counts, so a restart, or another split of the same messages into files, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilcount.operators.threshold import well_formed

CLASSES = "epoch SMALLINT, prefix ARRAY<STRING>, threshold INT, n BIGINT, goes_on BOOLEAN"


def running_counts(messages: DataFrame, lifetime: str) -> DataFrame:
    """Counts of the classes of a stream of messages: epoch, layers, threshold and epoch_end, a timestamp.

    epoch_end must be the same for all messages of an epoch. The state of an epoch is dropped, and messages that still
    arrive for it are left out, once a message has come whose epoch ends more than ``lifetime`` later. Rows are summed
    before the shuffle, so a prefix that every message shares is one row a task.
    """
    good = well_formed(F.col("layers"))
    rows = messages.withWatermark("epoch_end", lifetime).withColumn("good", good).withColumn(
        "depth", F.explode(F.when(F.col("good") > 0, F.sequence(F.lit(1), F.col("good"))).otherwise(F.array()))
    )
    classes = rows.groupBy("epoch_end", "epoch", F.expr("slice(layers, 1, depth)").alias("prefix"), "threshold")
    return classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("depth") < F.size("layers")).alias("goes_on"))


def start_counts(
    messages: DataFrame, folder: str, checkpoint: str, lifetime: str, available_now: bool = False
) -> StreamingQuery:
    """Start the stream. ``folder`` belongs to the checkpoint; a trigger that is run again replaces what it had landed."""

    def land(rows: DataFrame, number: int) -> None:
        rows.drop("epoch_end").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    counted = running_counts(messages, lifetime).writeStream.outputMode("update").foreachBatch(land)
    return counted.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def landed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The latest counts of all classes, as ``reveal`` takes them. Counts only grow, so the largest is the latest."""
    rows = spark.read.schema(CLASSES).parquet(folder)
    return rows.groupBy("epoch", "prefix", "threshold").agg(F.max("n").alias("n"), F.max("goes_on").alias("goes_on"))
