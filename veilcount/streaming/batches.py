"""Aggregation runs fed by a stream: the source itself says where each bounded batch ends, from its metadata.

The limit of a batch is the source's own: ``maxOffsetsPerTrigger`` of a topic (``records.stream_options``),
``maxFilesPerTrigger`` of landed files. Every record is read from the source once, when the micro-batch lands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilcount.plans.job import Aggregation, Outcome
from veilcount.session import new_work_folder
from veilcount.sources import records as rec


def run_micro_batch(job: Aggregation, records: DataFrame) -> Outcome | None:
    """One batch of the job from the records of a micro-batch; None if all of them are committed already.

    Records below the committed offsets are left out, so a micro-batch that is run again after its commit, or a stream that
    starts anew without its checkpoint, adds nothing. Offsets must grow within a partition from batch to batch.
    """
    committed = job.tables.progress().next_offsets
    folder = new_work_folder(job.spark, "landed")
    seen = Observation()
    new = rec.after(records, committed).observe(seen, F.count(F.lit(1)).alias("messages"))
    new.write.mode("overwrite").parquet(folder)
    messages = seen.get["messages"]
    if not messages:
        return None
    landed = job.spark.read.schema(records.schema).parquet(folder)
    ends = {row.partition: row.next_offset for row in rec.extent(landed).collect()}  # one row per partition
    return job.run_records(landed, messages, committed | ends)


def start_run(
    job: Aggregation, records: DataFrame, checkpoint: str, available_now: bool = True, done: list[Outcome] | None = None
) -> StreamingQuery:
    """Start a run on a stream of records. Outcomes are added to ``done``.

    An available-now run takes all that waited when it began, in bounded batches; the limits ``iterations`` and
    ``min_messages`` of the settings are for runs that read ranges of offsets.
    """

    def take(rows: DataFrame, _: int) -> None:
        outcome = run_micro_batch(job, rows)
        if outcome and done is not None:
            done.append(outcome)

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 hour"}
    return records.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start()
