"""Runs fed by a stream, look-ups by ranges of tags, and landed progress."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import as_changes, recovered
from veilcount.functions.epochs import EpochClock, EpochLength
from veilcount.operators import incremental, monitoring, state
from veilcount.plans.job import Aggregation, Settings
from veilcount.session import new_work_folder
from veilcount.sources import records as rec
from veilcount.streaming.batches import run_micro_batch, start_run
from veilcount.streaming.progress import PROGRESS, ProgressLog

RECORD = "value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, partition INT, offset BIGINT, timestamp TIMESTAMP"


def record_rows(spark, first, last, chains=3):
    """Records of offsets from first to before last in two partitions; chains take turns."""
    at = datetime(2024, 1, 1)
    rows = [
        (json.dumps({"epoch": 1, "layers": ["a|1", f"b|{offset % chains}"]}).encode(), None, partition, offset, at)
        for offset in range(first, last)
        for partition in (0, 1)
    ]
    return spark.createDataFrame(rows, RECORD)


def job(spark, **settings):
    clock = EpochClock(2, datetime(2024, 1, 8), EpochLength(days=7))
    return Aggregation(spark, Settings(clock, new_work_folder(spark, "job"), default_threshold=4, min_messages=1, **settings))


def counts(run):
    return sorted((tuple(f"{c.name}|{c.value}" for c in r.chain), r["count"]) for r in run.tables.recovered().collect())


def test_streamed_batches_equal_ranges_of_offsets(spark):
    """Three arrivals, a new start for each: the same measurements as of a run over landed ranges, and one read a record."""
    source, checkpoint = new_work_folder(spark, "source"), new_work_folder(spark, "progress")
    streamed, done, log = job(spark), [], ProgressLog(spark, new_work_folder(spark, "log"))
    spark.streams.addListener(log)
    try:
        for first, last in ((0, 3), (3, 10), (10, 11)):
            record_rows(spark, first, last).write.mode("append").parquet(source)
            stream = spark.readStream.schema(RECORD).parquet(source)
            query = start_run(streamed, stream, checkpoint, done=done)
            query.awaitTermination()
            log.wait(query)
    finally:
        spark.streams.removeListener(log)
    ranged = job(spark, max_messages=8)
    ranged.run(record_rows(spark, 0, 11))
    part = [F.get_json_object("json", f"$.{name}").alias(name) for name in "ab"]
    totals = lambda run: sorted(tuple(r) for r in run.measurements().groupBy(*part).agg(F.sum("total")).fillna("").collect())
    assert [outcome.messages for outcome in done] == [6, 14, 2] and totals(streamed) == totals(ranged) != []
    assert streamed.tables.progress().next_offsets == {0: 11, 1: 11}
    assert [r.records for r in log.rows().orderBy("batch").collect()] == [6, 14, 2]


def test_micro_batch_again_after_its_commit_adds_nothing(spark):
    run = job(spark)
    assert run_micro_batch(run, record_rows(spark, 0, 6)).messages == 12
    before = counts(run)
    assert run_micro_batch(run, record_rows(spark, 0, 6)) is None and counts(run) == before
    assert run_micro_batch(run, record_rows(spark, 4, 8)).messages == 4  # a stream without its checkpoint starts anew
    assert run_micro_batch(run, record_rows(spark, 0, 0)) is None


def test_end_of_a_source_is_asked_without_reading(spark):
    source = new_work_folder(spark, "source")
    record_rows(spark, 0, 3).coalesce(1).write.parquet(source)
    assert "logOffset" in str(rec.end_offset(spark.readStream.schema(RECORD).parquet(source)))


def test_offsets_of_a_topic():
    ends = rec.topic_ends('{"t":{"0":7,"2":5},"other":{"0":9}}', "t")
    assert ends == {0: 7, 2: 5} and rec.topic_ends(None, "t") == {} and rec.topic_ends("{}", "t") == {}
    assert rec.waiting_known(ends, {0: 4, 2: 5}) == [(0, 3, 4, 7)] and rec.waiting_known(ends, {}) == []
    options = rec.stream_options("host:1", "t", 10)
    assert options["maxOffsetsPerTrigger"] == "10" and "endingOffsets" not in options
    assert "maxOffsetsPerTrigger" not in rec.stream_options("host:1", "t", None)


def read_rows(frame):
    """Rows that the scans of a frame gave out while it was collected, and the collected rows."""
    rows = frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(at).metrics().apply("numOutputRows").value() for at in range(leaves.size())), rows


def test_rows_read_follow_the_tags_asked_for(spark):
    tables = state.StateTables(spark, new_work_folder(spark, "state"), incremental.PENDING)
    number = F.col("id")
    tags = spark.range(200_000).select(F.unhex(F.substring(F.sha1(number.cast("string")), 1, 40)).alias("tag"), number)
    rows = tags.select(F.lit(1).cast("smallint").alias("epoch"), "tag", F.lit(5).alias("threshold"), F.array(F.lit("a|1")).alias("layers"), F.lit(1).alias("depth"), F.lit(1).cast("bigint").alias("n"))
    tables.write("pending", 0, rows.coalesce(1))
    tables.write_nothing("recovered", 0)
    tables.commit(0)
    read = {}
    for asked in (1, 10, 100, 200_000):
        wanted = tags.filter(number < asked)
        near = tables.read("pending").filter(state.in_ranges(state.tag_ranges(wanted)))
        read[asked], found = read_rows(near)
        assert {r.tag for r in wanted.collect()} <= {r.tag for r in found}
    assert read[1] <= 2 * state.PAGE_ROWS and read[10] <= 20 * state.PAGE_ROWS and read[10] < read[100] <= read[200_000] == 200_000
    assert tables.read("pending").filter(state.in_ranges([])).count() == 0


def test_ranges_hold_their_tags(spark):
    tags = [b"\x00" * 20, b"\xff" * 20, b"\x05", b"\x05" + b"\xff" * 19, b"\x07\x01" + b"\x00" * 18, b""]
    frame = spark.createDataFrame([(tag,) for tag in tags], "tag BINARY")
    ranges = state.tag_ranges(frame)
    assert len(ranges) == 4 and ranges[-1][1] is None
    assert frame.filter(state.in_ranges(ranges)).count() == len(tags)
    assert spark.createDataFrame([(b"\x06" * 20,), (b"\x07\x03" * 10,)], "tag BINARY").filter(state.in_ranges(ranges)).count() == 0
    assert state.tag_ranges(frame.filter("tag IS NULL")) == [] and state.tag_ranges(spark.createDataFrame([(None,)], "tag BINARY")) == []


def test_many_tags_make_one_range(spark):
    tags = spark.range(20_000).select(F.unhex(F.substring(F.sha1(F.col("id").cast("string")), 1, 40)).alias("tag"))
    ranges = state.tag_ranges(tags)
    assert len(ranges) == 1 and tags.filter(state.in_ranges(ranges)).count() == 20_000
    apart = spark.createDataFrame([(b"\x05\xff" * 10,), (b"\x06" + b"\x01" * 19,), (b"\x07\x80" * 10,)], "tag BINARY")
    assert [low[:1] for low, _ in state.tag_ranges(apart)] == [b"\x05", b"\x07"]


def test_look_up_by_ranges_equals_the_whole_state(spark):
    known = recovered(spark, [(n, 1, "a", str(n), None, 5, False) for n in range(1, 120)])
    tables = state.StateTables(spark, new_work_folder(spark, "state"), incremental.PENDING)
    tables.write("recovered", 0, as_changes(known))
    tables.write_nothing("pending", 0)
    tables.commit(0)
    asked = known.filter(F.col("count") == 5).select("epoch", "tag").limit(7)
    asked = spark.createDataFrame(asked.collect(), "epoch SMALLINT, tag BINARY")
    whole = state.lookup_recovered(asked, tables.read("recovered"))
    near = state.lookup_recovered(asked, tables.read("recovered").filter(state.in_ranges(state.tag_ranges(asked))))
    assert sorted(whole.collect()) == sorted(near.collect()) and near.count() == 7


def test_lag_of_landed_progress(spark):
    row = lambda name, batch, end, latest: ("q", name, batch, "t", 0, "kafka", 1, None, end, latest)
    rows = [
        row("a", 0, '{"t":{"0":1}}', '{"t":{"0":90}}'),
        row("a", 1, '{"t":{"0":5,"1":7}}', '{"t":{"0":9,"1":7,"2":3}}'),
        row("b", 0, None, '{"t":{"0":4}}'),
    ]
    found = monitoring.stream_lag(spark.createDataFrame(rows, PROGRESS))
    assert sorted(tuple(r) for r in found.collect()) == [("a", "t", 7), ("b", "t", 4)]


@pytest.mark.parametrize("stored, waiting", [([("a", 3)], 4), ([], 7)])
def test_received_saved_and_waiting(spark, stored, waiting):
    rows = spark.createDataFrame([("q", "a", n, "t", 0, "files", 3 + n, None, None, None) for n in range(2)], PROGRESS)
    found = monitoring.stream_progress(rows, spark.createDataFrame(stored, "name STRING, saved BIGINT")).first()
    assert (found.received, found.waiting) == (7, waiting)
