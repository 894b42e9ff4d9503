"""Intake, records and measurement files on small inputs."""

import base64

import pytest
from pyspark.sql import functions as F

from veilcount.functions.text import little_endian_u32, split_measurement, strict_base64, unsigned_header
from veilcount.operators import threshold as th
from veilcount.session import new_work_folder
from veilcount.sources import intake, records as rec, synth


def strings(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")


def listed(frame, column):
    return [r.c for r in frame.select("i", column.alias("c")).orderBy("i").collect()]


def test_strict_base64(spark):
    long = base64.b64encode(bytes(range(256))).decode()
    texts = ["aGVsbG8=", "aGVsbG8", "aGVsbG9=", "aGVs\nbG8=", "", "a", "aGVsbG8= ", "_-__", long, long[:76] + "\r\n" + long[76:]]
    got = listed(strings(spark, texts), strict_base64(F.col("v")))
    assert [g and bytes(g) for g in got] == [b"hello", None, None, None, b"", None, None, None, bytes(range(256)), None]


def test_unsigned_header(spark):
    texts = ["7", "+7", "-7", " 7", "7 ", "7\n", "x", "", None, "007", "18446744073709551615", "18446744073709551616", "٣"]
    got = listed(strings(spark, texts), unsigned_header(F.col("v")))
    assert [g and int(g) for g in got] == [7, 7, None, None, None, None, None, None, None, 7, 2**64 - 1, None, None]


def test_little_endian_threshold(spark):
    values = [bytes([0x32, 0, 0, 0]), bytes([0x32, 0]), bytes([0x32, 1, 0, 0]), b"", bytes([255] * 4)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v BINARY")
    assert listed(frame, little_endian_u32(F.col("v"))) == [50, 0, 306, 0, 2**32 - 1]


def test_header_rules(spark):
    headers = [None, [], [("threshold", b"\x14\0\0\0")], [("threshold", b"\x14\0\0\0"), ("threshold", b"\x01")], [("threshold", None)], [("x", b"")]]
    frame = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i INT, headers ARRAY<STRUCT<key: STRING, value: BINARY>>")
    assert listed(rec.with_threshold(frame), F.col("threshold")) == [50, 50, 20, 0, 0, 50]


def test_split_measurement(spark):
    texts = ["a|b", "a|b|c", "ab", "a|\0b\0\0", "|", "a|b\0c", "\0a|b"]
    got = listed(strings(spark, texts), split_measurement(F.col("v")))
    assert [g and tuple(g) for g in got] == [("a", "b"), None, None, ("a", "b"), ("", ""), ("a", "b\0c"), ("\0a", "b")]


GOOD = base64.b64encode(b'{"epoch":7,"layers":["a|1","b|2"]}')


@pytest.mark.parametrize(
    "channel,body,revision,threshold,status,accepted",
    [
        ("main", GOOD, "3", None, 204, True),
        (None, GOOD, "3", "20", 204, True),
        ("nosuch", b"%%%", None, None, 404, False),
        ("main", b"%%%", "1", None, 400, False),
        ("main", b"\xff" + GOOD, "3", None, 400, False),
        ("main", GOOD[:-1], "3", None, 400, False),
        ("main", GOOD, "2", "99", 204, False),
        ("main", GOOD, None, None, 204, False),
        ("open", GOOD, None, "19", 400, False),
        ("open", GOOD, None, "51", 400, False),
        ("open", GOOD, None, "fifty", 204, True),
        ("open", "  ".encode() + GOOD + b"\r\n", None, "50", 204, True),
        ("open", base64.b64encode(b'{"epoch":256,"layers":["a|1"]}'), None, None, 400, False),
        ("open", base64.b64encode(b'{"epoch":1,"layers":[]}'), None, None, 400, False),
        ("open", base64.b64encode(b'{"epoch":1,"layers":["a|1",null]}'), None, None, 400, False),
        ("open", base64.b64encode(b'{"epoch":1,"layers":["a|1"'), None, None, 400, False),
        ("open", b"", None, None, 400, False),
    ],
)
def test_intake_order(spark, channel, body, revision, threshold, status, accepted):
    frame = spark.createDataFrame(
        [(channel, body, revision, threshold)], "channel STRING, body BINARY, revision STRING, threshold STRING"
    )
    channels = intake.channel_table(spark, [intake.Channel("main", 3), intake.Channel("open")])
    row = intake.classify(frame, channels, "main").first()
    assert (row.status, row.accepted) == (status, accepted)


def test_accepted_submissions_keep_their_bytes_and_threshold(spark):
    frame = spark.createDataFrame(
        [("open", GOOD, None, "30"), ("open", GOOD, None, None)],
        "channel STRING, body BINARY, revision STRING, threshold STRING",
    )
    channels = intake.channel_table(spark, [intake.Channel("open")])
    made = intake.to_records(intake.classify(frame, channels, "open"))
    assert {bytes(r.value) for r in made.collect()} == {base64.b64decode(GOOD)}
    assert sorted(r.threshold for r in rec.with_threshold(made).collect()) == [30, 50]


def test_bad_record_stops_or_is_kept_apart(spark):
    frame = spark.createDataFrame(
        [(b'{"epoch":1,"layers":["a|1"]}', None, 0, 0), (b"junk", None, 0, 1)],
        "value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, partition INT, offset BIGINT",
    )
    kept = rec.to_messages(frame, mode="quarantine").collect()
    assert sorted(r.message is None for r in kept) == [False, True]
    with pytest.raises(Exception, match="does not parse"):
        rec.to_messages(frame).collect()


def test_csv_measurements(spark):
    folder = new_work_folder(spark, "csv")
    lines = ["city,rooms,floor,total", "Oulu,3, ,2", " Faro ,1,4,1", "Oulu,3,,4"]
    strings(spark, lines).coalesce(1).select("v").write.text(folder)
    rows = synth.repeat(synth.csv_measurements(spark, folder)).collect()
    assert sorted(r.layers for r in rows) == sorted([["city|Oulu", "rooms|3", "floor|"]] * 6 + [["city|Faro", "rooms|1", "floor|4"]])


def test_generated_sets_are_recovered_in_full(spark):
    rows = synth.generated_messages(spark.range(10), "id")
    assert rows.count() == 500
    frame = rows.select(F.lit(1).cast("smallint").alias("epoch"), "layers", F.lit(50).alias("threshold"))
    assert [(len(r.prefix), r.total, r.is_partial) for r in th.reveal(frame).collect()] == [(7, 50, False)] * 10


def test_shares_go_where_records_wait():
    assert rec.shares({0: 3, 1: 100, 2: 5, 3: 100}, 100) == {0: 3, 2: 5, 1: 46, 3: 46}
    assert rec.shares({0: 3, 1: 4}, 100) == {0: 3, 1: 4}
    assert rec.shares({}, 100) == {}


def offsets_of(spark, rows):
    return rec.Landed(spark.createDataFrame(rows, "partition INT, offset BIGINT"))


def read_all(source, limit):
    """The batches of a source until nothing waits."""
    committed, batches = {}, []
    while (batch := rec.bounded_batch(source, committed, limit)).waiting:
        batches.append(sorted(tuple(r) for r in batch.records.collect()))
        committed = batch.next_offsets
        assert len(batches) < 100
    return batches


def test_every_record_is_in_one_batch(spark):
    uneven = [(7, at) for at in range(500)] + [(0, at) for at in range(2_000, 2_030)] + [(3, 5), (3, 100_000), (3, 100_001)]
    batches = read_all(offsets_of(spark, uneven), 100)
    assert sorted(row for batch in batches for row in batch) == sorted(uneven)
    assert all(0 < len(batch) <= 100 for batch in batches)


def test_end_of_a_batch_is_fixed_before_it_is_read(spark):
    folder = new_work_folder(spark, "growing")
    write = lambda rows: spark.createDataFrame(rows, "partition INT, offset BIGINT").write.mode("append").parquet(folder)
    write([(0, at) for at in range(10)])
    batch = rec.bounded_batch(rec.Landed(spark.read.parquet(folder)), {}, 100)
    write([(0, at) for at in range(10, 20)])
    later = rec.Landed(spark.read.parquet(folder))
    assert later.between({0: 0}, batch.next_offsets).count() == 10 and batch.next_offsets == {0: 10}
    assert [r.offset for r in rec.bounded_batch(later, batch.next_offsets, 100).records.orderBy("offset").collect()] == list(range(10, 20))


def test_offset_ranges_reach_the_scan(spark):
    folder = new_work_folder(spark, "landed")
    spark.range(100).select((F.col("id") % 2).cast("int").alias("partition"), "id").withColumnRenamed("id", "offset").write.parquet(folder)
    batch = rec.bounded_batch(rec.Landed(spark.read.parquet(folder)), {0: 10, 1: 30}, 20)
    plan = batch.records._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(offset,10)" in pushed and "LessThan(offset," in pushed
    # Of 100 offsets every other one is missing in each partition, so a share of ten offsets holds five records.
    assert batch.records.count() == 10 and batch.next_offsets == {0: 20, 1: 41}


def test_topic_options():
    options = rec.topic_options("host:1", "t", {1: 5, 0: rec.EARLIEST}, {0: 7, 1: 9})
    assert options["startingOffsets"] == '{"t": {"0": -2, "1": 5}}' and options["endingOffsets"] == '{"t": {"0": 7, "1": 9}}'
    assert rec.topic_options("h", "t", None, None)["endingOffsets"] == "latest"
