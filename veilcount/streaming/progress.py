"""Progress of running streams as a table: what each micro-batch took, and where the source ended then."""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query STRING, name STRING, batch BIGINT, at STRING, source INT, description STRING, records BIGINT, "
    "start_offset STRING, end_offset STRING, latest_offset STRING"
)


class ProgressLog(StreamingQueryListener):
    """Lands a row per micro-batch and source below ``folder``. A micro-batch that is run again replaces its rows.

    Register it with ``spark.streams.addListener``. Events arrive behind the streams; ``wait`` returns once all of a
    query that has ended are landed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        found = event.progress
        rows = [
            (
                str(found.id), found.name, found.batchId, found.timestamp, number, source.description, source.numInputRows,
                source.startOffset, source.endOffset, source.latestOffset,
            )
            for number, source in enumerate(found.sources)
        ]
        table = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.folder}/run={found.id}/part={found.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def _end_of(self, run: str) -> Event:
        return self._ended.setdefault(run, Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the progress of query {query.id} has not arrived")

    def rows(self) -> DataFrame:
        """All landed rows."""
        return self.spark.read.schema(PROGRESS).parquet(f"{self.folder}/run=*/part=*")
