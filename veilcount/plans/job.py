"""The aggregation run: bounded batches over earlier state, reports, and expiry of old epochs.

A batch writes its measurements and its state first and its commit row last. The commit row also holds the offsets to
read next, so that a run that dies is repeated with the same input, and overwrites what it had written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilcount.functions.epochs import EpochClock
from veilcount.operators import incremental, report, sealed, state
from veilcount.operators.state import COMMITS, StateTables
from veilcount.session import drop_folder, new_work_folder
from veilcount.sources import records as rec
from veilcount.sources.intake import CLEAR_ENVELOPE, SEALED_ENVELOPE

MEASUREMENT = "epoch SMALLINT, total BIGINT, survey_date STRING, json STRING, is_partial BOOLEAN"


@dataclass(frozen=True)
class Settings:
    """Settings of one channel's runs."""

    clock: EpochClock
    folder: str
    sealed: bool = False
    default_threshold: int = rec.DEFAULT_THRESHOLD
    max_messages: int = rec.MAX_MESSAGES
    iterations: int = rec.MAX_ITERATIONS
    min_messages: int = rec.MIN_MESSAGES
    on_bad_record: str = "failfast"
    fixed_children: bool = False
    purge_pending_only: bool = False
    max_failed: int = state.MAX_FAILED
    max_failed_top: int = state.MAX_FAILED_TOP
    compact_every: int = state.COMPACT_EVERY
    #: Seconds after which files that no commit needs are deleted; None keeps them for a ``vacuum`` of the caller's.
    delete_after: float | None = 86_400


@dataclass(frozen=True)
class Outcome:
    batch: int
    messages: int
    reported: int
    errors: int


class Aggregation:
    def __init__(self, spark: SparkSession, settings: Settings, now: Column | None = None):
        self.spark = spark
        self.settings = settings
        self.now = F.current_timestamp() if now is None else now
        pending = sealed.PENDING if settings.sealed else incremental.PENDING
        self.tables = StateTables(spark, f"{settings.folder.rstrip('/')}/state", pending)
        self.output = f"{settings.folder.rstrip('/')}/measurements"

    # -- input ---------------------------------------------------------------------------------------------------------

    def parsed(self, records: DataFrame) -> DataFrame:
        """Records with their message and threshold, by the settings of the channel."""
        schema = SEALED_ENVELOPE if self.settings.sealed else CLEAR_ENVELOPE
        return rec.to_messages(records, schema, self.settings.on_bad_record, self.settings.default_threshold)

    def messages_of(self, records: DataFrame) -> DataFrame:
        """Messages of a batch of records, in the form the mode needs: clear ones with the number ``n`` of equal records."""
        parsed = self.parsed(records if self.settings.sealed else rec.alike(records))
        if self.settings.on_bad_record == "quarantine":
            parsed = parsed.filter(F.col("message").isNotNull())
        epoch = F.col("message.epoch").cast("smallint").alias("epoch")
        threshold = F.col("threshold").cast("int").alias("threshold")
        if not self.settings.sealed:
            return parsed.select(epoch, "message.layers", threshold, "n")
        return parsed.select(
            epoch,
            F.unbase64("message.tag").alias("tag"),
            threshold,
            "message.msg_id",
            "message.x",
            "message.y",
            F.unbase64("message.ct").alias("ct"),
            F.unbase64("message.inner").alias("inner"),
        )

    def keep_bad_records(self, records: DataFrame) -> int:
        """Write the records of the next batch that do not parse to a table of their own. Returns their number."""
        folder = f"{self.tables.folder}/bad_records/batch={self.tables.progress().last + 1}"
        bad = self.parsed(records).filter(F.col("message").isNull()).select("partition", "offset", "value")
        bad.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(bad.schema).parquet(folder).count()

    def quarantine(self) -> DataFrame | None:
        """Messages that committed batches lost because their layers did not open; None if there are none."""
        return self.tables.side_table("quarantine")

    def bad_records(self) -> DataFrame | None:
        """Records that committed batches could not parse; None if there are none."""
        return self.tables.side_table("bad_records")

    # -- one batch -----------------------------------------------------------------------------------------------------

    def run_batch(self, messages: DataFrame, count: int, next_offsets: dict[int, int] | None = None) -> Outcome:
        """Process a batch of messages and commit it."""
        progress = self.tables.progress()
        batch = progress.last + 1
        work = new_work_folder(self.spark, f"batch-{batch}")
        known_changes = self.tables.read("recovered", progress)
        pending = self.tables.read("pending", progress).drop("batch")
        limits = self.settings.max_failed, self.settings.max_failed_top
        if self.settings.sealed:
            recovered = state.current_recovered(known_changes, self.settings.fixed_children)
            done = sealed.process_batch(messages, recovered, pending, work, count, *limits, salt=batch)
        else:
            tags = known_changes.select("epoch", "tag").distinct()
            done = incremental.process_batch(messages, tags, pending, work, count, *limits)
            known_changes = known_changes.filter(F.col("epoch").isin(done.epochs))
        done.quarantine.write.mode("overwrite").parquet(f"{self.tables.folder}/quarantine/batch={batch}")
        errors = done.errors
        changes = self._written(state.checked_changes(done.changes), f"{work}/changes")

        touched = changes.select("epoch", "tag")
        before = known_changes.filter(state.in_ranges(state.tag_ranges(touched))).join(touched.distinct(), ["epoch", "tag"], "left_semi")
        now_recovered = state.current_recovered(
            before.unionByName(changes.withColumn("batch", F.lit(batch).cast("bigint"))), self.settings.fixed_children
        )
        current = self._written(now_recovered, f"{work}/current")
        emitted = self._written(report.full_report(current), f"{work}/emitted")
        reported = self.write_measurements(batch, emitted, partial=False)
        taken = report.reported_changes(emitted)
        self.tables.write("recovered", batch, changes.unionByName(taken, allowMissingColumns=True))
        self.tables.write("pending", batch, state.checked_pending(done.pending))
        self.tables.commit(batch, next_offsets=next_offsets, reported=reported, errors=errors)
        drop_folder(self.spark, work)  # all that is kept is committed
        # Batches since the last base are bounded, so the files and commit rows that a batch reads are too.
        if len(progress.batches) + 1 >= self.settings.compact_every:
            self.tables.compact(self.settings.fixed_children)
        return Outcome(batch, count, reported, errors)

    def _written(self, rows: DataFrame, path: str) -> DataFrame:
        """The rows as a table, which later steps read instead of computing them again."""
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def write_measurements(self, batch: int, emitted: DataFrame, partial: bool) -> int:
        """Write the report of a batch; its readers see it once the batch is committed. Returns the sum of totals."""
        rows = report.measurements(emitted, self.settings.clock, self.now).withColumn("is_partial", F.lit(partial))
        seen = Observation()
        rows.observe(seen, F.sum("total").alias("total")).write.mode("overwrite").parquet(f"{self.output}/batch={batch}")
        return seen.get.get("total") or 0  # summed while the rows are written

    # -- whole run -----------------------------------------------------------------------------------------------------

    def run(self, records: DataFrame | rec.Topic | rec.Landed) -> list[Outcome]:
        """Up to ``iterations`` bounded batches. With too few messages waiting, they are left unread and the run ends."""
        source = rec.Landed(records) if isinstance(records, DataFrame) else records
        done = []
        for _ in range(self.settings.iterations):
            part = rec.bounded_batch(source, self.tables.progress().next_offsets, self.settings.max_messages)
            if part.waiting == 0 or part.waiting < self.settings.min_messages:
                break
            # A gap can leave a batch smaller than its range; what is counted is what is read.
            done.append(self.run_records(part.records, part.records.count(), part.next_offsets))
        return done

    def run_records(self, records: DataFrame, count: int, next_offsets: dict[int, int]) -> Outcome:
        """Process a batch of so many records and commit it."""
        bad = self.keep_bad_records(records) if self.settings.on_bad_record == "quarantine" else 0
        return self.run_batch(self.messages_of(records), count - bad, next_offsets)

    def run_all(self, records: DataFrame | rec.Topic | rec.Landed) -> tuple[list[Outcome], list[int]]:
        """A whole run: its batches, then the partial reports of the epochs that have expired, then the deletion of files."""
        done = self.run(records), self.expire()
        if self.settings.delete_after is not None:
            self.tables.vacuum(self.settings.delete_after)
        return done

    def expire(self) -> list[int]:
        """Report what is left of expired epochs as partial measurements and purge them."""
        progress = self.tables.progress()
        changes = self.tables.read("recovered", progress)
        recovered = state.current_recovered(changes, self.settings.fixed_children)
        listed = changes.select("epoch").distinct()
        if self.settings.purge_pending_only:
            listed = listed.unionByName(self.tables.read("pending", progress).select("epoch")).distinct()
        expired = [row.epoch for row in report.expired_rows(listed, self.settings.clock, self.now).collect()]
        if not expired:
            return []
        batch = progress.last + 1
        work = new_work_folder(self.spark, f"batch-{batch}")
        left = self._written(report.nonzero(recovered, expired), f"{work}/left")
        emitted = self._written(report.partial_report(left), f"{work}/emitted")
        reported = self.write_measurements(batch, emitted, partial=True)
        self.tables.purge(expired, batch, reported)
        drop_folder(self.spark, work)
        return sorted(expired)

    def measurements(self) -> DataFrame:
        """Measurements of all committed batches."""
        try:
            written = self.spark.read.schema(f"{MEASUREMENT}, batch BIGINT").parquet(self.output)
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.tables.folder}/commits").select("batch")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], f"{MEASUREMENT}, batch BIGINT")
            raise
        return written.join(commits.distinct(), "batch", "left_semi")
