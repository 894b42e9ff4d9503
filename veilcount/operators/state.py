"""State between runs: recovered tags and pending messages.

Both are append-only tables with one folder per batch. Recovered rows are changes to a tag's count, and the current
row is their sum, so that an upsert is an append and a sum. A pending row is live as long as its tag is not recovered,
so that deleting the pending messages of an opened tag needs no rewrite. A batch becomes visible through one commit
row, written last; running an uncommitted batch again overwrites its folders.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilcount.functions.conditions import any_of

# What a row of the state may hold.
MAX_NAME, MAX_VALUE, MAX_THRESHOLD = 64, 128, 32_767
# How many messages of one class may fail to open as a whole before the run stops.
MAX_FAILED, MAX_FAILED_TOP = 75, 500
# Committed batches between two base batches.
COMPACT_EVERY = 32
# Rows of a page of the state's files, of which a look-up reads whole ones.
PAGE_ROWS = 1_000
# The gap between two ranges of tags below which they are read as one: an eighth of the tags with one first byte.
LEAST_GAP = 1 << 45

RECOVERED_CHANGES = (
    "epoch SMALLINT, tag BINARY, parent_tag BINARY, name STRING, value STRING, path ARRAY<BINARY>, "
    "chain ARRAY<STRUCT<name: STRING, value: STRING>>, key BINARY, change BIGINT, has_children BOOLEAN"
)
COMMITS = "batch BIGINT, base BOOLEAN, purged ARRAY<SMALLINT>, next_offsets MAP<INT, BIGINT>, reported BIGINT, errors BIGINT"


def current_recovered(changes: DataFrame, fixed_children: bool = False) -> DataFrame:
    """One row per (epoch, tag): the summed count, and the attributes of the smallest parent.

    ``has_children`` becomes true with the first child. With ``fixed_children`` it keeps the value of the first batch,
    for which ``changes`` needs its ``batch`` column.
    """
    attributes = F.struct("parent_tag", "name", "value", "path", "chain", "key")
    # Rows that only take reported counts away say nothing about children.
    first = F.min(F.when(F.col("has_children").isNotNull(), F.struct("batch", "has_children")))
    children = first["has_children"] if fixed_children else F.max("has_children")
    return (
        changes.groupBy("epoch", "tag")
        .agg(
            F.min(F.when(F.col("path").isNotNull(), attributes)).alias("a"),
            F.sum("change").alias("count"),
            children.alias("has_children"),
        )
        .select("epoch", "tag", "a.*", "count", "has_children")
    )


def lookup_recovered(tags: DataFrame, recovered: DataFrame) -> DataFrame:
    """State rows of the given (epoch, tag) pairs."""
    return recovered.join(tags.select("epoch", "tag").distinct(), ["epoch", "tag"], "left_semi")


def tag_ranges(tags: DataFrame) -> list[tuple[bytes, bytes | None]]:
    """For each first byte the range from the smallest to the largest of the given tags, at most 256 ranges.

    Ranges with hardly a gap between them are one. Bounds are the first seven bytes; the upper one is exclusive, None is no
    bound. Few tags make ranges that hold little besides them, many tags make one range that holds everything.
    """
    head = F.conv(F.hex(F.rpad(F.substring("tag", 1, 7), 7, b"\0")), 16, 10).cast("bigint")
    heads = tags.select(head.alias("head")).groupBy(F.shiftright("head", 48).alias("first"))
    found = heads.agg(F.min("head").alias("low"), F.max("head").alias("high")).orderBy("first").collect()

    def bound(number: int) -> bytes:
        return number.to_bytes(7, "big").rstrip(b"\0")

    joined: list[list[int]] = []
    for row in found:
        if row.low is None:
            continue
        if joined and row.low - joined[-1][1] < LEAST_GAP:
            joined[-1][1] = row.high + 1
        else:
            joined.append([row.low, row.high + 1])
    return [(bound(low), bound(end) if end < 1 << 56 else None) for low, end in joined]


def in_ranges(ranges: list[tuple[bytes, bytes | None]]) -> Column:
    """Whether a tag lies in one of the ranges, as plain comparisons that reach the scan."""
    tag = F.col("tag")
    return any_of([(tag >= F.lit(low)) if high is None else (tag >= F.lit(low)) & (tag < F.lit(high)) for low, high in ranges])


def live_pending(pending: DataFrame, recovered: DataFrame) -> DataFrame:
    """Pending messages whose tag has not been recovered since."""
    return pending.join(recovered.select("epoch", "tag"), ["epoch", "tag"], "left_anti")


def lookup_pending(tags: DataFrame, recovered: DataFrame, pending: DataFrame) -> DataFrame:
    """Live pending messages of the given tags, looked up only for tags that are not recovered.

    Both joins start from the pending rows, of which no tag holds many; the tags are distinct before they are joined.
    """
    asked = pending.join(tags.select("epoch", "tag").distinct(), ["epoch", "tag"], "left_semi")
    return live_pending(asked, recovered)


def still_pending(new: DataFrame, opened: DataFrame) -> DataFrame:
    """New messages of tags that were not opened."""
    return new.join(opened.select("epoch", "tag").distinct(), ["epoch", "tag"], "left_anti")


def children(recovered: DataFrame) -> DataFrame:
    """(epoch, parent tag, child tag); the parent of a root tag is NULL."""
    return recovered.select("epoch", "parent_tag", "tag")


def within_bounds(name: F.Column, value: F.Column, threshold: F.Column) -> F.Column:
    """Whether a row fits the state columns."""
    fits = (F.char_length(name) <= MAX_NAME) & (F.char_length(value) <= MAX_VALUE) & threshold.between(0, MAX_THRESHOLD)
    return F.coalesce(fits, F.lit(False))


def checked_changes(changes: DataFrame) -> DataFrame:
    """Fail the job at a name or value that is too long for the recovered table."""
    fits = within_bounds(F.col("name"), F.col("value"), F.lit(0))
    problem = F.concat(F.lit("name or value missing or too long: "), F.coalesce(F.substring("name", 1, MAX_NAME), F.lit("")))
    return changes.withColumn("name", F.when(~fits, F.raise_error(problem)).otherwise(F.col("name")))


def checked_pending(pending: DataFrame) -> DataFrame:
    """Fail the job at a threshold that is too large for the pending table."""
    problem = F.concat(F.lit("threshold too large: "), F.col("threshold"))
    fits = F.col("threshold").between(0, MAX_THRESHOLD)
    return pending.withColumn("threshold", F.when(~fits, F.raise_error(problem)).otherwise(F.col("threshold")))


@dataclass
class Progress:
    """Everything the commit rows say. Few and small: one row per batch, at most 256 epochs, one offset per partition."""

    batches: list[int] = field(default_factory=list)
    purged_at: dict[int, int] = field(default_factory=dict)
    next_offsets: dict[int, int] = field(default_factory=dict)

    @property
    def last(self) -> int:
        return self.batches[-1] if self.batches else -1


class StateTables:
    """Append-only tables under one folder, read through the committed batches only."""

    def __init__(self, spark: SparkSession, folder: str, pending_schema: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schemas = {"recovered": RECOVERED_CHANGES, "pending": pending_schema}

    def progress(self) -> Progress:
        """What the commit rows say, from the last base batch on."""
        try:
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return Progress()
            raise
        base = commits.agg(F.max(F.when(F.col("base"), F.col("batch")))).first()[0]
        wanted = commits if base is None else commits.filter(F.col("batch") >= base)
        found = Progress()
        for row in wanted.orderBy("batch").collect():
            found.batches.append(row.batch)
            found.purged_at.update({epoch: row.batch for epoch in row.purged or []})
            found.next_offsets.update(row.next_offsets or {})
        return found

    def write(self, table: str, batch: int, rows: DataFrame) -> None:
        # Rebalancing by epoch gives few files per epoch, and splits an epoch that holds most rows.
        # Sorted by tag, the statistics of its pages let a look-up by ranges of tags skip the others.
        sized = rows.hint("rebalance", "epoch").sortWithinPartitions("epoch", "tag")
        written = sized.write.mode("overwrite").partitionBy("epoch").option("parquet.page.row.count.limit", PAGE_ROWS)
        written.parquet(f"{self.folder}/{table}/batch={batch}")

    def read(self, table: str, progress: Progress | None = None) -> DataFrame:
        """Rows of all committed batches, without the epochs that were purged after they were written."""
        progress = progress or self.progress()
        schema = f"{self.schemas[table]}, batch BIGINT"
        paths = [f"{self.folder}/{table}/batch={b}" for b in progress.batches]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.folder}/{table}").parquet(*paths)
        for epoch, batch in progress.purged_at.items():
            rows = rows.filter((F.col("epoch") != epoch) | (F.col("batch") > batch))
        return rows

    def recovered(self, progress: Progress | None = None, fixed_children: bool = False) -> DataFrame:
        return current_recovered(self.read("recovered", progress), fixed_children)

    def commit(
        self,
        batch: int,
        purged: list[int] = (),
        next_offsets: dict[int, int] | None = None,
        reported: int = 0,
        errors: int = 0,
        base: bool = False,
    ) -> None:
        """Make a batch visible. The row is a single file, which appears as a whole or not at all."""
        row = (batch, base, [int(e) for e in purged], next_offsets or {}, reported, errors)
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/commits/run={batch}"
        )

    def write_nothing(self, table: str, batch: int) -> None:
        self.write(table, batch, self.spark.createDataFrame([], self.schemas[table]))

    def purge(self, epochs: list[int], batch: int | None = None, reported: int = 0) -> int:
        """Hide all rows of the epochs in both tables; their files are no longer read, and ``vacuum`` deletes them."""
        batch = self.progress().last + 1 if batch is None else batch
        for table in self.schemas:
            self.write_nothing(table, batch)
        self.commit(batch, purged=epochs, reported=reported)
        return batch

    def commits(self) -> DataFrame:
        """The commit rows of all batches, with what each reported and lost."""
        return self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits")

    def stored(self, table: str) -> DataFrame:
        """Every row of a table that any file below its folder still holds, visible or not."""
        schema = f"{self.schemas[table]}, batch BIGINT"
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{table}").parquet(f"{self.folder}/{table}/batch=*")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], schema)
            raise

    def unneeded(self, grace_seconds: float = 0) -> list[str]:
        """Folders that no reader of the committed state needs: batches before the last base batch, and the folders of
        purged epochs in batches up to their purge.

        A folder counts once the commit that made it unneeded is older than ``grace_seconds``, so that readers which started
        before that commit can finish. Batches that are not committed are left to be run again. The folders are listed
        from the file system; after a compaction there are as many as batches since the one before, times epochs.
        """
        progress = self.progress()
        if not progress.batches:
            return []
        base, found = progress.batches[0], []
        for table in self.schemas:
            for number, path in self._numbered(f"{self.folder}/{table}", "batch"):
                if number < base:
                    if self._settled(base, grace_seconds):
                        found.append(path)
                    continue
                for epoch, inner in self._numbered(path, "epoch"):
                    purge = progress.purged_at.get(epoch, -1)
                    if number <= purge and self._settled(purge, grace_seconds):
                        found.append(inner)
        return found

    def vacuum(self, grace_seconds: float = 0) -> int:
        """Delete the files of the unneeded folders, through the Hadoop file system of the state. Returns their number.

        Nothing that is deleted is named by a commit row, so a vacuum that dies is simply run again. Messages that have been
        opened go with the batches before a base batch, which holds what still waits.
        """
        folders = self.unneeded(grace_seconds)
        for folder in folders:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            self._file_system().delete(path, True)
        return len(folders)

    def _file_system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbered(self, folder: str, name: str) -> list[tuple[int, str]]:
        """Numbers and paths of the folders ``name=number`` in a folder."""
        system, path = self._file_system(), self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not system.exists(path):
            return []
        parts = ((status.getPath().getName().partition("="), status.getPath().toString()) for status in system.listStatus(path))
        return sorted((int(number), found) for (key, _, number), found in parts if key == name and number.lstrip("-").isdigit())

    def _settled(self, batch: int, grace_seconds: float) -> bool:
        """Whether a batch was committed at least so many seconds ago."""
        if grace_seconds <= 0:
            return True
        commit = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/run={batch}")
        return self._file_system().getFileStatus(commit).getModificationTime() / 1000 + grace_seconds <= time.time()

    def side_table(self, name: str) -> DataFrame | None:
        """Rows of ``quarantine`` or ``bad_records``, of all committed batches that wrote any; None if there are none."""
        try:
            rows = self.spark.read.parquet(f"{self.folder}/{name}")
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits").select("batch")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise
        return rows.join(commits.distinct(), "batch", "left_semi")

    def compact(self, fixed_children: bool = False) -> int:
        """Write the current state as one base batch, after which older folders are no longer read."""
        progress = self.progress()
        batch = progress.last + 1
        recovered = self.recovered(progress, fixed_children)
        self.write("recovered", batch, recovered.withColumnRenamed("count", "change"))
        self.write("pending", batch, live_pending(self.read("pending", progress).drop("batch"), recovered))
        self.commit(batch, next_offsets=progress.next_offsets, base=True)
        return batch
