"""The running intake: a stream of submissions becomes landed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from veilcount.sources.intake import CLEAR_ENVELOPE, classify, to_records


def start_intake(
    submissions: DataFrame,
    channels: DataFrame,
    main_channel: str,
    folder: str,
    checkpoint: str,
    schema: str = CLEAR_ENVELOPE,
    available_now: bool = False,
) -> StreamingQuery:
    """Land accepted submissions as records, one folder per channel. The file sink lists each micro-batch once."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    return (
        to_records(classify(submissions, channels, main_channel, schema))
        .writeStream.format("parquet")
        .partitionBy("channel")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
