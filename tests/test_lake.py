"""Lake lines, flush batches and the running sink."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilcount.operators import monitoring
from veilcount.session import new_work_folder
from veilcount.sinks import lake
from veilcount.streaming.lake_sink import start_lake_sink, store_batch


def lines(spark, rows):
    return spark.createDataFrame(rows, "channel STRING, line STRING")


def test_date_field(spark):
    given = ['{"a":1,"ymd":"old"}', "", "  ", "[1,2]", '"x"', '{"n":{"b":[1.5,null]}}']
    rows = lines(spark, [("dated", g) for g in given] + [("other", "  "), ("other", "not json")])
    got = lake.with_date_field(rows, F.lit("2024-01-01"), ["dated"]).collect()
    dated = [json.loads(r.line) for r in got if r.channel == "dated"]
    assert sorted(dated, key=str) == sorted(
        [{"a": 1, "ymd": "2024-01-01"}, [1, 2], "x", {"n": {"b": [1.5, None]}, "ymd": "2024-01-01"}], key=str
    )
    assert sorted(r.line for r in got if r.channel == "other") == ["  ", "not json"]


def test_last_of_repeated_keys_counts(spark):
    rows = lines(spark, [("dated", '{"a":1,"b":0,"a":2}')])
    got = lake.with_date_field(rows, F.lit("2024-01-01"), ["dated"]).first().line
    assert json.loads(got) == {"a": 2, "b": 0, "ymd": "2024-01-01"}


def test_broken_json_fails(spark):
    with pytest.raises(Exception, match="not JSON"):
        lake.with_date_field(lines(spark, [("dated", "{")]), F.lit("2024-01-01"), ["dated"]).collect()


def batches(spark, seconds, size=1_000, chunks=5, idle=45):
    start = datetime(2024, 1, 1)
    rows = [("c", start + timedelta(seconds=s), i) for i, s in enumerate(seconds)]
    frame = spark.createDataFrame(rows, "channel STRING, ts TIMESTAMP, record_id BIGINT")
    out = lake.flush_batches(frame, idle, size, chunks)
    return [(r.session, r.batch) for r in out.orderBy("record_id").collect()]


def test_full_batches(spark):
    sizes = {}
    for key in batches(spark, [0] * 2_500):
        sizes[key] = sizes.get(key, 0) + 1
    assert sizes == {(0, 0): 1_000, (0, 1): 1_000, (0, 2): 500}


def test_only_a_longer_gap_splits(spark):
    assert batches(spark, [0, 45, 91, 92]) == [(0, 0), (0, 0), (1, 0), (1, 0)]


def test_batches_equal_a_plain_walk(spark):
    seconds, at = [], 0
    for i in range(500):
        at += (i * 7919) % 61
        seconds.append(at)
    expected, session, place, last = [], 0, 0, None
    for s in seconds:
        if last is not None and s - last > 45:
            session, place = session + 1, 0
        expected.append((session, place // 3))
        place, last = place + 1, s
    assert batches(spark, seconds, size=3, chunks=16) == expected


def test_replayed_micro_batch_adds_nothing(spark):
    folder = new_work_folder(spark, "lake")
    rows = lines(spark, [("a", '{"x":1}'), ("b", '{"x":2}')])
    store_batch(rows, 0, folder, [], lambda: "2024-01-01")
    store_batch(rows, 0, folder, [], lambda: "2024-01-01")
    store_batch(rows.limit(1), 1, folder, [], lambda: "2024-01-01")
    assert lake.read_jsonl(spark, folder).count() == 3


def test_stream_goes_on_after_a_restart(spark):
    source, folder, progress = (new_work_folder(spark, n) for n in ("source", "lake", "progress"))
    for batch in range(2):
        lines(spark, [("a", f'{{"x":{batch}}}')]).write.mode("append").parquet(source)
        stream = spark.readStream.schema("channel STRING, line STRING").parquet(source)
        start_lake_sink(stream, folder, progress, ["a"], available_now=True, today=lambda: "2024-01-01").awaitTermination()
    got = [json.loads(r.line) for r in lake.read_jsonl(spark, folder).collect()]
    assert sorted(got, key=str) == [{"x": 0, "ymd": "2024-01-01"}, {"x": 1, "ymd": "2024-01-01"}]


def test_new_checkpoint_adds_lines(spark):
    source, folder = new_work_folder(spark, "source"), new_work_folder(spark, "lake")
    lines(spark, [("a", '{"x":1}')]).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("channel STRING, line STRING").parquet(source)
        progress = new_work_folder(spark, "progress")
        start_lake_sink(stream, folder, progress, [], available_now=True, today=lambda: "2024-01-01").awaitTermination()
    assert lake.read_jsonl(spark, folder).count() == 2


def test_replay_keeps_the_first_date(spark):
    folder = new_work_folder(spark, "lake")
    rows = lines(spark, [("a", '{"x":1}')])
    for day in ("2024-01-01", "2024-01-02"):
        store_batch(rows, 0, folder, ["a"], lambda: day, query="q")
    store_batch(rows, 1, folder, ["a"], lambda: "2024-01-02", query="q")
    got = sorted((r.date, json.loads(r.line)["ymd"]) for r in lake.read_jsonl(spark, folder).collect())
    assert got == [("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-02")]


def test_topic_writer_options():
    assert lake.topic_writer_options("h:1", "out") == {"kafka.bootstrap.servers": "h:1", "topic": "out"}


@pytest.mark.parametrize("n", [1, 2, 10, 100, 333])
def test_percentiles(spark, n):
    values = [(i * 7919) % 100_000 for i in range(n)]
    frame = spark.createDataFrame([("s", v) for v in values], "stat STRING, ms BIGINT")
    row = monitoring.timing_summary(frame).first()
    ordered = sorted(values)
    import numpy as np

    at = lambda p: ordered[int(np.floor(np.float32(n) * np.float32(p)))]
    assert (row.p50, row.p75, row.p90, row.p99) == (at(0.5), at(0.75), at(0.9), at(0.99))
    assert (row["min"], row["max"], row["sum"], row["count"]) == (ordered[0], ordered[-1], sum(values), n)
