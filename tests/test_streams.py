"""The running flush rule, class counts as a stateful stream, keyed topic records and chains from parent pointers."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rows import recovered, tag
from veilcount.operators import report, threshold as th
from veilcount.session import new_work_folder
from veilcount.sinks import lake
from veilcount.streaming.counts import landed_counts, start_counts
from veilcount.streaming.flushing import flush_micro_batch, start_flushing_sink
from veilcount.streaming.lake_sink import store_batch

START = datetime(2024, 1, 1)
LINE = "channel STRING, ts TIMESTAMP, record_id BIGINT, line STRING"


def line_rows(spark, seconds, first=0, channel="c"):
    rows = [(channel, START + timedelta(seconds=s), first + i, f"line {first + i}") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, LINE)


class Flushing:
    """Micro-batches one after another, and what they stored."""

    def __init__(self, spark, size, idle=45):
        self.spark, self.size, self.idle = spark, size, idle
        self.folder, self.out = new_work_folder(spark, "flushing"), new_work_folder(spark, "stored")

    def run(self, rows, number, now=None):
        store = lambda closed, at: closed.write.mode("overwrite").parquet(f"{self.out}/batch={at}")
        flush_micro_batch(rows, number, self.folder, store, self.idle, self.size, now)

    def stored(self):
        rows = self.spark.read.parquet(self.out).collect()
        return sorted((r.channel, r.session, r.flush, r.record_id) for r in rows)


def walk(seconds, size, idle=45):
    """(session, flush) of each row by the rule, and the label that is open after the last row."""
    labels, session, place, last = [], 0, 0, None
    for s in seconds:
        if last is not None and s - last > idle:
            session, place = session + 1, 0
        labels.append((session, place // size))
        place, last = place + 1, s
    return labels, (labels[-1] if place % size else None)


@pytest.mark.parametrize("cuts", [[120], [1, 2, 60], [40, 41, 80]])
def test_flushes_equal_a_plain_walk_over_any_split(spark, cuts):
    seconds, at = [], 0
    for i in range(120):
        at += (i * 7919) % 53
        seconds.append(at)
    labels, still_open = walk(seconds, 4)
    run, first = Flushing(spark, 4), 0
    for number, cut in enumerate([*cuts, 120]):
        run.run(line_rows(spark, seconds[first:cut], first), number)
        first = cut
    assert run.stored() == [("c", *label, i) for i, label in enumerate(labels) if label != still_open]


def test_repeated_micro_batch_changes_nothing(spark):
    run = Flushing(spark, 3)
    run.run(line_rows(spark, [0, 1]), 0)
    for _ in range(2):
        run.run(line_rows(spark, [2, 3], 2), 1)
    run.run(line_rows(spark, [4, 5], 4), 2)
    assert run.stored() == [("c", 0, 0, 0), ("c", 0, 0, 1), ("c", 0, 0, 2), ("c", 0, 1, 3), ("c", 0, 1, 4), ("c", 0, 1, 5)]


def test_silence_of_one_channel_closes_it_while_others_go_on(spark):
    run = Flushing(spark, 10)
    run.run(line_rows(spark, [0, 45]).union(line_rows(spark, [50], 9, "d")), 0)
    assert run.stored() == []
    run.run(line_rows(spark, [91], 10, "d"), 1)
    assert run.stored() == [("c", 0, 0, 0), ("c", 0, 0, 1)]
    run.run(line_rows(spark, [89, 300], 2), 2)  # the first comes within the gap, behind a closed flush of its session
    assert run.stored()[:3] == [("c", 0, 0, 0), ("c", 0, 0, 1), ("c", 0, 1, 2)]


def test_rows_without_channel_or_time_and_empty_micro_batches(spark):
    run = Flushing(spark, 2)
    none = spark.createDataFrame([(None, START, 1, "x"), ("c", None, 2, "y")], LINE)
    run.run(none, 0)
    run.run(line_rows(spark, [0]), 1)
    run.run(none.limit(0), 2)
    assert run.stored() == []
    run.run(none.limit(0), 3, now=F.lit(START + timedelta(seconds=46)))
    assert run.stored() == [("c", 0, 0, 0)]


def test_live_sink_flushes_into_the_lake_while_no_line_arrives(spark):
    source, folder, progress, out = (new_work_folder(spark, n) for n in ("source", "flushing", "progress", "lake"))
    line_rows(spark, [0, 1, 2]).write.parquet(source)
    stream = spark.readStream.schema(LINE).parquet(source)
    store = lambda closed, number: store_batch(closed, number, out, [], lambda: "2024-01-01", "live")
    query = start_flushing_sink(stream, folder, progress, store, idle_seconds=1, batch_size=2)
    try:
        found, until = [], time.time() + 90
        while len(found) < 3 and time.time() < until and query.isActive:
            time.sleep(1)
            try:
                found = [row.line for row in lake.read_jsonl(spark, out).collect()]
            except Exception:  # nothing is stored yet
                pass
    finally:
        query.stop()
    assert sorted(found) == ["line 0", "line 1", "line 2"]


MESSAGE = "epoch SMALLINT, layers ARRAY<STRING>, threshold INT, epoch_end TIMESTAMP"


def test_counts_go_on_after_a_restart_and_equal_one_aggregation(spark):
    source, folder, progress = (new_work_folder(spark, n) for n in ("source", "classes", "progress"))
    layers = [["a|1", "b|1"], ["a|1", "b|2"], ["a|1"], ["a|1", "bad", "c|1"], ["bad"], []]
    rows = [(i % 2, layers[i % 6], 2 + i % 3, START + timedelta(days=7 * (i % 2 + 1))) for i in range(60)]
    for part in (rows[:7], rows[7:8], rows[8:]):
        spark.createDataFrame(part, MESSAGE).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MESSAGE).parquet(source)
        start_counts(stream, folder, progress, "30 days", available_now=True).awaitTermination()
    shown = lambda frame: sorted((r.epoch, tuple(r.prefix), r.total, r.is_partial) for r in frame.collect())
    whole = spark.createDataFrame(rows, MESSAGE).drop("epoch_end")
    assert shown(th.reveal(whole, landed_counts(spark, folder))) == shown(th.reveal(whole))


def test_state_of_an_old_epoch_is_dropped(spark):
    source, folder, progress = (new_work_folder(spark, n) for n in ("source", "classes", "progress"))

    def run(epoch, days):
        row = (epoch, ["a|1"], 2, START + timedelta(days=days))
        spark.createDataFrame([row], MESSAGE).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MESSAGE).parquet(source)
        query = start_counts(stream, folder, progress, "10 days", available_now=True)
        query.awaitTermination()
        return query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    assert run(0, 7) == 1
    assert run(3, 28) == 1  # the later epoch's row is the only one left
    run(0, 7)
    counts = {row.epoch: row.n for row in landed_counts(spark, folder).collect()}
    assert counts == {0: 1, 3: 1}


MEASURED = "epoch SMALLINT, total BIGINT, survey_date STRING, json STRING, is_partial BOOLEAN, batch BIGINT"


def test_repeated_records_are_read_once_and_equal_measurements_are_kept(spark):
    rows = [(0, 5, "d", "{}", False, 1), (0, 5, "d", "{}", False, 1), (0, 5, "d", "{}", True, 1), (0, 5, "d", "{}", False, 2)]
    written = lake.topic_records(spark.createDataFrame(rows, MEASURED), "run")
    again = lake.topic_records(spark.createDataFrame(rows[::-1], MEASURED).repartition(3), "run")
    assert lake.kept_once(written.union(again)).count() == 4
    assert lake.kept_once(written.union(lake.topic_records(spark.createDataFrame(rows, MEASURED), "other"))).count() == 8
    without = spark.createDataFrame([(None, b"a"), (None, b"a")], "key BINARY, value BINARY")
    assert lake.kept_once(without).count() == 2
    assert lake.topic_records(spark.createDataFrame([], MEASURED), "run").count() == 0


def chains(spark, rows, deepest=1_024):
    found = report.chains_from_parents(rows, new_work_folder(spark, "chains"), deepest).collect()
    return {(r.epoch, bytes(r.tag)[0]): [c.value for c in r.chain] for r in found}


def test_chains_of_any_depth_and_rows_below_a_missing_parent(spark):
    rows = [(i, 0, "n", f"v{i}", i - 1 if i > 1 else None, 1, True) for i in range(1, 12)]
    rows += [(i, 1, "n", f"w{i}", parent, 1, True) for i, parent in ((1, None), (2, 1), (4, 3), (5, 4))]
    found = chains(spark, recovered(spark, rows))
    expected = {(0, i): [f"v{j}" for j in range(1, i + 1)] for i in range(1, 12)}
    assert found == expected | {(1, 1): ["w1"], (1, 2): ["w1", "w2"]}
    assert chains(spark, recovered(spark, rows).limit(0)) == {}


def test_cycles_and_too_long_chains_fail(spark):
    line = recovered(spark, [(i, 0, "n", "v", i - 1 if i > 1 else None, 1, True) for i in range(1, 8)])
    with pytest.raises(Exception, match="more than 4 layers"):
        chains(spark, line, 4)
    assert len(chains(spark, line, 7)) == 7
    cycle = line.withColumn("parent_tag", F.coalesce("parent_tag", F.lit(tag(3))))
    with pytest.raises(ValueError, match="a cycle"):
        chains(spark, cycle, 64)
