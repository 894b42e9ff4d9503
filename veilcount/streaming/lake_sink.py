"""The running lake sink: a stream of measurement lines lands in the dated JSON-lines lake."""

from __future__ import annotations

from datetime import datetime, timezone
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilcount.sinks.lake import BATCH_SIZE, IDLE_SECONDS, with_date_field


def _today() -> str:
    return datetime.now(timezone.utc).date().isoformat()


def store_batch(
    lines: DataFrame,
    batch: int,
    folder: str,
    dated_channels: list[str],
    today: Callable[[], str] = _today,
    query: str | None = None,
) -> None:
    """Write one micro-batch of a query. Its own folders are replaced if it is run again, so a replay adds nothing.

    The folders carry the query's id, which lives as long as its checkpoint: another query, or a new checkpoint, never
    touches them. A batch keeps the date of its first attempt, also when it is run again after midnight.
    """
    spark = lines.sparkSession
    query = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    day = _date_of(spark, f"{folder}/_dates/query={query}/batch={batch}", today)
    date = F.lit(day)
    (
        with_date_field(lines, date, dated_channels)
        .select(
            date.alias("date"), "channel", F.lit(query).alias("query"), F.lit(batch).alias("batch"), F.col("line").alias("value")
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", BATCH_SIZE)
        .partitionBy("date", "channel", "query", "batch")
        .text(folder)
    )


def _date_of(spark: SparkSession, path: str, today: Callable[[], str]) -> str:
    """The date that the batch was given first, noted before any of its lines is written."""
    try:
        noted = spark.read.text(path).first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        noted = None
    if noted is None:
        spark.createDataFrame([(today(),)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
        noted = spark.read.text(path).first()
    return noted.value


def start_lake_sink(
    lines: DataFrame,
    folder: str,
    checkpoint: str,
    dated_channels: list[str] = (),
    available_now: bool = False,
    today: Callable[[], str] = _today,
) -> StreamingQuery:
    """Start the sink on a stream of (channel, line). Progress is saved after each stored batch."""
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{IDLE_SECONDS} seconds"}
    return (
        lines.writeStream.foreachBatch(lambda rows, batch: store_batch(rows, batch, folder, list(dated_channels), today))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
