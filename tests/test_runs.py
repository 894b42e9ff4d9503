"""Runs over several batches against a message-by-message walk in plain Python."""

import json
import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import messages
from veilcount.functions.epochs import EpochClock, EpochLength
from veilcount.operators import sealed, state, threshold as th
from veilcount.plans.job import Aggregation, Settings
from veilcount.session import new_work_folder

CLOCK = EpochClock(0, datetime(2024, 1, 8), EpochLength(days=7), lifetime=1)


def walk(batches):
    """Open tags batch by batch.

    Returns {(epoch, prefix): total} over full and expiry reports, the waiting messages, and those of them of which
    nothing is revealed.
    """
    known, waiting, taken = set(), defaultdict(list), defaultdict(int)
    for batch in batches:
        arriving = [(e, tuple(layers), t, 1) for e, layers, t, n in batch for _ in range(n)]
        while arriving:
            tags = defaultdict(list)
            for m in arriving:
                tags[m[0], m[1][: m[3]]].append(m)
            arriving = []
            for tag, new in tags.items():
                both = new + waiting[tag]
                classes = {m[2] for m in new}
                if tag in known or any(k >= 2 and sum(m[2] == k for m in both) >= k for k in classes):
                    known.add(tag)
                    waiting[tag] = []
                    for e, layers, t, depth in both:
                        taken[e, layers[: depth - 1]] -= 1
                        taken[e, layers[:depth]] += 1
                        if depth < len(layers):
                            arriving.append((e, layers, t, depth + 1))
                else:
                    waiting[tag] = both
    totals = {k: v for k, v in taken.items() if k[1] and v}
    unrevealed = sum(len(v) for (_, prefix), v in waiting.items() if len(prefix) == 1)
    return totals, sum(len(v) for v in waiting.values()), unrevealed


def cases(seed, epochs, batches, depth, per_case=60, thresholds=(2, 3, 5)):
    """Random batches; every epoch is a case of its own."""
    rng = random.Random(seed)
    made = []
    for _ in range(batches):
        rows = []
        for epoch in epochs:
            size = rng.randint(2, 3)
            for _ in range(rng.randint(1, per_case // 10)):
                layers = [f"l{d}|{rng.randrange(size)}" for d in range(depth)]
                rows.append((epoch, layers, rng.choice(thresholds), rng.randint(1, 3)))
        made.append(rows)
    return made


def reported(job):
    totals = defaultdict(int)
    for r in job.measurements().collect():
        fields = json.loads(r.json)
        prefix = tuple(f"l{d}|{fields[f'l{d}']}" for d in range(len(fields) - 2))
        totals[r.epoch, prefix] += r.total
    return {k: v for k, v in totals.items() if v}


def aggregation(spark, **settings):
    now = F.lit("2024-01-03").cast("timestamp")
    return Aggregation(spark, Settings(CLOCK, new_work_folder(spark, "job"), **settings), now)


def test_clear_runs_equal_the_walk(spark):
    epochs = range(1, 200)
    batches = cases(1, epochs, 3, 3, thresholds=(0, 1, 2, 3, 5))
    expected, hidden, unrevealed = walk(batches)
    assert expected
    everything = messages(spark, [row for batch in batches for row in batch])
    at_once = {(r.epoch, tuple(r.prefix)): r.total for r in th.reveal(everything).collect()}
    assert at_once == expected

    job = aggregation(spark)
    for batch in batches:
        frame = messages(spark, batch)
        job.run_batch(frame, frame.count())
    live = state.live_pending(job.tables.read("pending"), job.tables.recovered())
    assert live.agg(F.sum("n")).first()[0] == hidden
    job.tables.compact()
    job.expire()
    assert reported(job) == expected
    assert sum(expected.values()) + unrevealed == everything.count()


def test_sealed_runs_equal_the_walk(spark):
    epochs = range(1, 20)
    batches = cases(2, epochs, 2, 2)
    expected, hidden, unrevealed = walk(batches)
    job = aggregation(spark, sealed=True)
    for number, batch in enumerate(batches):
        clear = messages(spark, batch).withColumn("msg_id", F.concat(F.lit(f"{number}-"), F.monotonically_increasing_id()))
        folder = new_work_folder(spark, "sealed")
        sealed.seal(clear, "secret", 2).write.parquet(folder)
        frame = spark.read.parquet(folder)
        job.run_batch(frame, frame.count())
    live = state.live_pending(job.tables.read("pending"), job.tables.recovered())
    assert live.count() == hidden
    job.expire()
    assert reported(job) == expected


def as_records(frame):
    """Clear messages as records of two partitions with their threshold in the header."""
    body = F.to_json(F.struct("epoch", "layers"))
    digits = F.lpad(F.hex("threshold"), 2, "0")
    header = F.array(F.struct(F.lit("threshold").alias("key"), F.unhex(F.concat(digits, F.lit("000000"))).alias("value")))
    return frame.select(body.cast("binary").alias("value"), header.alias("headers"), "partition", "offset")


def test_bounded_run_reads_on_and_leaves_small_rests(spark):
    frame = spark.range(100).select(
        F.lit(1).cast("smallint").alias("epoch"),
        F.array(F.lit("l0|1")).alias("layers"),
        F.lit(20).alias("threshold"),
        (F.col("id") % 2).cast("int").alias("partition"),
        F.floor(F.col("id") / 2).alias("offset"),
    )
    job = aggregation(spark, max_messages=40, iterations=5, min_messages=30)
    done = job.run(as_records(frame))
    assert [o.messages for o in done] == [40, 40]
    assert job.tables.progress().next_offsets == {0: 40, 1: 40}
    assert [o.reported for o in done] == [40, 40]
    assert job.run(as_records(frame)) == []


def test_partitions_are_found_and_rests_count_together(spark):
    """All records in one of several partitions, which starts late and which no offset names yet."""
    frame = spark.range(50).select(
        F.lit(1).cast("smallint").alias("epoch"),
        F.array(F.lit("l0|1")).alias("layers"),
        F.lit(20).alias("threshold"),
        F.lit(7).alias("partition"),
        (F.col("id") + 2_000).alias("offset"),
    )
    job = aggregation(spark, max_messages=20, iterations=5, min_messages=10)
    assert [o.messages for o in job.run(as_records(frame))] == [20, 20, 10]
    assert job.tables.progress().next_offsets == {7: 2_050}
    assert reported(job) == {(1, ("l0|1",)): 50}


def test_malformed_layers_are_lost_or_stop_the_run(spark):
    rows = [(1, ["l0|1", "nodelim"], 3, 4), (1, ["l0|1", "b|x|y", "c|1"], 3, 5), (1, ["l0|1", "l1|2"], 3, 3), (1, ["bad"], 3, 2)]
    job = aggregation(spark)
    outcome = job.run_batch(messages(spark, rows), 14)
    assert (outcome.errors, outcome.reported) == (9, 3)
    lost = {(r.layers[1], r.n) for r in job.quarantine().collect()}
    assert lost == {("nodelim", 4), ("b|x|y", 5)}
    job.run_batch(messages(spark, [(1, ["bad"], 3, 1)]), 1)
    assert job.quarantine().agg(F.sum("n")).first()[0] == 10  # the one that opened the tag; two go on waiting
    job.expire()
    assert reported(job) == {(1, ("l0|1", "l1|2")): 3, (1, ("l0|1",)): 9}
    few = aggregation(spark, max_failed=4)
    with pytest.raises(Exception, match="no message opens"):
        few.run_batch(messages(spark, rows), 14)
    assert few.quarantine() is None and few.measurements().count() == 0
    top = aggregation(spark, max_failed=0, max_failed_top=2)
    assert top.run_batch(messages(spark, [(1, ["bad"], 2, 2)]), 2).errors == 2


def test_batches_with_compactions_equal_the_walk(spark):
    batches = cases(5, range(1, 6), 7, 2)
    expected, _, _ = walk(batches)
    job = aggregation(spark, compact_every=3)
    for batch in batches:
        frame = messages(spark, batch)
        job.run_batch(frame, frame.count())
        assert len(job.tables.progress().batches) <= 3
    job.expire()
    assert reported(job) == expected


def test_late_messages_start_from_empty_state(spark):
    job = aggregation(spark)
    first = messages(spark, [(1, ["l0|1"], 3, 4)])
    job.run_batch(first, 4)
    assert job.expire() == [1]
    late = messages(spark, [(1, ["l0|1"], 3, 2)])
    job.run_batch(late, 2)
    assert reported(job) == {(1, ("l0|1",)): 4}
    more = messages(spark, [(1, ["l0|1"], 3, 1)])
    job.run_batch(more, 1)
    assert reported(job) == {(1, ("l0|1",)): 7}


def test_epochs_with_only_pending_rows(spark):
    few = [(1, ["l0|1"], 3, 1)]
    kept, purged = aggregation(spark), aggregation(spark, purge_pending_only=True)
    for job in (kept, purged):
        job.run_batch(messages(spark, few), 1)
    assert kept.expire() == [] and kept.tables.read("pending").count() == 1
    assert purged.expire() == [1] and purged.tables.read("pending").count() == 0


def test_copies_of_one_share_do_not_hide_the_others(spark):
    """A class that is mostly copies of one message still gives its key."""
    clear = spark.range(5_000).select(
        F.lit(1).cast("smallint").alias("epoch"),
        F.array(F.lit("l0|1")).alias("layers"),
        F.lit(3).alias("threshold"),
        F.when(F.col("id") < 4, F.col("id")).otherwise(0).cast("string").alias("msg_id"),
    )
    folder = new_work_folder(spark, "sealed")
    sealed.seal(clear, "secret", 1).write.parquet(folder)
    job = aggregation(spark, sealed=True)
    job.run_batch(spark.read.parquet(folder), 5_000)
    assert reported(job) == {(1, ("l0|1",)): 5_000}


def test_state_bounds_stop_the_run(spark):
    job = aggregation(spark)
    for rows in ([(1, ["n|" + "v" * 129], 2, 2)], [(1, ["n" * 65 + "|v"], 2, 2)], [(1, ["n|v"], 40_000, 2)]):
        with pytest.raises(Exception, match="too l"):
            job.run_batch(messages(spark, rows), 2)
    job.run_batch(messages(spark, [(1, ["n" * 64 + "|" + "v" * 128], 2, 2)]), 2)
    assert job.measurements().count() == 1


def test_bad_records_stop_the_run_or_are_kept_apart(spark):
    good = spark.range(6).select(
        F.lit(1).cast("smallint").alias("epoch"),
        F.array(F.lit("l0|1")).alias("layers"),
        F.lit(3).alias("threshold"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    no_header = as_records(good).withColumn("headers", F.when(F.col("offset") > 0, F.col("headers")))
    records = no_header.withColumn("value", F.when(F.col("offset") == 5, F.lit(b"junk")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="does not parse"):
        aggregation(spark, min_messages=1, iterations=1).run(records)
    job = aggregation(spark, min_messages=1, iterations=1, on_bad_record="quarantine", default_threshold=3)
    assert [o.reported for o in job.run(records)] == [5]
    kept = job.bad_records()
    assert [(r.offset, bytes(r.value)) for r in kept.collect()] == [(5, b"junk")]
    assert {r.threshold for r in job.messages_of(records).collect()} == {3}


def test_equal_records_are_parsed_once(spark):
    rows = spark.range(60).select(
        F.lit(1).cast("smallint").alias("epoch"),
        F.array(F.lit("l0|1")).alias("layers"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(50).alias("threshold"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    records = as_records(rows)
    records = records.unionByName(records.limit(1).withColumns({"headers": F.lit(None).cast(records.schema["headers"].dataType), "offset": F.lit(60).cast("bigint")}))
    job = aggregation(spark, min_messages=1, iterations=1, default_threshold=7)
    found = job.messages_of(records).collect()
    assert sorted((r.epoch, r.layers, r.threshold, r.n) for r in found) == [(1, ["l0|1"], 2, 20), (1, ["l0|1"], 7, 1), (1, ["l0|1"], 50, 40)]
    assert [(o.messages, o.reported) for o in job.run(records)] == [(61, 61)]
