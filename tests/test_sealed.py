"""Shares, keys and opening on small inputs."""

import base64
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rows import RECOVERED, tag
from veilcount.catalog import sealed as queries
from veilcount.functions import polynomials, shares as sh
from veilcount.functions.tags import prefix_tag
from veilcount.functions.text import base64_text
from veilcount.operators import sealed
from veilcount.session import new_work_folder

P = sh.PRIME


def interpolate(points):
    """The value at 0, in plain Python."""
    total = 0
    for i, (xi, yi) in enumerate(points):
        weight = 1
        for j, (xj, _) in enumerate(points):
            if i != j:
                weight = weight * xj * pow(xj - xi, P - 2, P) % P
        total = (total + yi * weight) % P
    return total


def test_shares_interpolate_to_the_limbs(spark):
    ids = spark.range(60).select(F.col("id").cast("string").alias("msg_id"))
    tag_of = prefix_tag(F.lit(3), F.array(F.lit("a|1"), F.lit("b|2")), "s")
    x = sh.share_point(F.col("msg_id"))
    rows = ids.select(
        x.alias("x"), sh.share_values(tag_of, F.lit(50), x, "s").alias("y"), sh.key_limbs(tag_of, "s").alias("limbs")
    ).collect()
    limbs = rows[0].limbs
    for j in range(sh.LIMBS):
        assert interpolate([(r.x, r.y[j]) for r in rows[:50]]) == limbs[j]
        assert interpolate([(r.x, r.y[j]) for r in rows[:49]]) != limbs[j]
    shares = spark.createDataFrame([([(r.x, list(r.y)) for r in rows[10:]],)], "s ARRAY<STRUCT<x: BIGINT, y: ARRAY<BIGINT>>>")
    got = shares.select(sh.secret_at_zero(F.col("s")).alias("l")).select("l", sh.key_of_limbs(F.col("l")).alias("k")).first()
    assert got.l == limbs
    assert bytes(got.k) == hashlib.sha256(",".join(map(str, limbs)).encode()).digest()


def test_values_of_many_messages_equal_those_of_one(spark):
    """Null, repeated and unknown keys included; the higher-order functions say what the values are."""
    rows = [(f"m{at}", at % 5 if at % 11 else None, (2, 3, 20, 50, None)[at % 7 % 5]) for at in range(300)] + [(None, 1, 20), ("m1", 1, 3)] * 2
    frame = spark.createDataFrame(rows, "msg_id STRING, layer INT, threshold INT")
    tag_of = prefix_tag(F.lit(3), F.array(F.concat(F.lit("a|"), F.col("layer").cast("string"))), "s")
    x = sh.share_point(F.col("msg_id"))
    made = polynomials.share_values(sh.class_seed(tag_of, F.col("threshold"), "s"), F.col("threshold"), x, sh.key_limbs(tag_of, "s"))
    told = frame.select(sh.share_values(tag_of, F.col("threshold"), x, "s").alias("one"), made.alias("many")).collect()
    assert len(told) == 304 and sum(r.one[0] is None for r in told) > 20
    assert [r.many for r in told] == [r.one for r in told]


def test_sealing_makes_a_class_of_values_at_once(spark):
    clear = spark.createDataFrame([(1, "m", ["a|1", "b|2"], 20)], "epoch SMALLINT, msg_id STRING, layers ARRAY<STRING>, threshold INT")
    plan = sealed.seal(clear, "s", 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and plan.count("xxhash64(") <= 4  # no hash for each message and degree


@pytest.mark.parametrize("chunked", ["true", "false"])
def test_base64_of_any_length_is_one_line(spark, chunked):
    spark.conf.set("spark.sql.legacy.chunkBase64String.enabled", chunked)
    try:
        rows = spark.range(200).select(F.expr("cast(repeat('a', cast(id as int)) as binary)").alias("b")).select("b", base64_text(F.col("b")).alias("t"))
        assert all(base64.b64encode(r.b).decode() == r.t for r in rows.collect())
        assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()
    finally:
        spark.conf.unset("spark.sql.legacy.chunkBase64String.enabled")


def test_a_batch_keeps_no_copy_of_its_messages(spark):
    """What is left in the work folder has none of the columns that hold the inner layers, but for what waits."""
    rows = [(1, f"m{at}", ["a|1", "b|2", "c|3"], 20) for at in range(60)]
    clear = spark.createDataFrame(rows, "epoch SMALLINT, msg_id STRING, layers ARRAY<STRING>, threshold INT")
    folder = new_work_folder(spark, "test")
    sealed.seal(clear, "s", 3).write.parquet(f"{folder}/in")
    messages = spark.read.parquet(f"{folder}/in")
    none, pending = spark.createDataFrame([], RECOVERED), spark.createDataFrame([], sealed.PENDING)
    done = sealed.process_batch(messages, none, pending, f"{folder}/work", 60)
    assert sum(r.change for r in done.changes.collect()) == 180 and done.pending.count() == done.quarantine.count() == 0
    left = {path.parent.name for path in Path(folder, "work").rglob("*.parquet")}
    assert left == {"counts", "eligible", "keys", "outcomes", "changes"}


def test_outer_tags_that_are_given_are_those_of_sealing(spark):
    rows = [(1, "m", ["a|1", "b|2"], 20), (1, "m", ["a|1", "b|2"], 20), (None, "n", ["a|1", "b|2"], 20), (1, None, [None, "b|2"], 50), (1, "o", [], 20)]
    clear = spark.createDataFrame(rows, "epoch SMALLINT, msg_id STRING, layers ARRAY<STRING>, threshold INT")
    own, given = sealed.seal(clear, "s", 2), sealed.seal(sealed.with_outer_tag(clear, "s"), "s", 2)
    assert own.columns == given.columns and sorted(map(str, own.collect())) == sorted(map(str, given.collect()))


def event_folder(spark, count):
    """A folder with an events table of one week, two types and so two outer tags."""
    folder = new_work_folder(spark, "test")
    number = F.col("id")
    spark.range(count).select(
        number.alias("event_id"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int))").alias("ts"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.when(number % 2 == 0, "view").otherwise("click").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.lit('{"k": 1}').alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    return folder


def test_opening_writes_no_sealed_messages(spark, monkeypatch):
    folders, new_folder = [], queries.new_work_folder
    monkeypatch.setattr(queries, "new_work_folder", lambda *given: folders.append(new_folder(*given)) or folders[-1])
    found = queries.open_layer(spark, event_folder(spark, 240)).collect()
    assert sorted((r.measurement, r.threshold, r.opened, r.next_opened) for r in found) == [
        ("type|click", 20, 80, 80), ("type|click", 50, 40, 40), ("type|view", 20, 80, 80), ("type|view", 50, 40, 40)
    ]
    assert folders and not any("inner" in spark.read.parquet(folder).columns for folder in folders)


SHARES = "epoch SMALLINT, tag BINARY, threshold INT, x BIGINT, y ARRAY<BIGINT>"


def test_equal_shares_do_not_count(spark):
    rows = [(1, tag(1), 3, 5, [1] * 8)] * 40 + [(1, tag(1), 3, 6, [2] * 8)]
    rows += [(1, tag(2), 3, x, [x] * 8) for x in (5, 6, 7)] + [(1, tag(3), 0, 5, [1] * 8), (1, tag(4), 1, 5, [1] * 8)]
    keys = sealed.recover_keys(sealed.share_sample(spark.createDataFrame(rows, SHARES))).collect()
    assert {r.tag[0]: r.key is not None for r in keys} == {1: False, 2: True, 4: False}


def test_sample_is_bounded(spark):
    rows = spark.range(1_000).select(
        F.lit(1).cast("smallint").alias("epoch"), F.lit(tag(1)).alias("tag"), F.lit(50).alias("threshold"),
        (F.col("id") + 1).alias("x"), F.array(F.col("id")).alias("y"),
    )
    assert sealed.share_sample(rows).count() == 66


def test_smallest_class_gives_the_key(spark):
    rows = [(1, tag(1), 20, None), (1, tag(1), 30, b"b"), (1, tag(1), 50, b"c"), (1, tag(2), 20, None)]
    keys = sealed.tag_keys(spark.createDataFrame(rows, "epoch SMALLINT, tag BINARY, threshold INT, key BINARY")).collect()
    assert [(r.tag[0], bytes(r.key)) for r in keys] == [(1, b"b")]


FLAGS = (
    "epoch SMALLINT, tag BINARY, threshold INT, parent_tag BINARY, msg_id STRING, opened BOOLEAN, has_next BOOLEAN, "
    "next_opened BOOLEAN, measurement STRING"
)


def outcomes(spark, rows, **limits):
    listed = [(1, tag(t), k, p, str(i).zfill(4), *rest) for i, (t, k, p, *rest) in enumerate(rows)]
    return {r.tag[0]: r for r in sealed.class_outcomes(spark.createDataFrame(listed, FLAGS), **limits).collect()}


def test_errors_count_only_above_a_next_layer(spark):
    leaf = [(1, 20, None, True, False, False, "a|1")] * 3 + [(1, 20, None, False, False, False, None)] * 2
    inner = [(2, 20, None, True, True, True, "a|2")] * 3 + [(2, 20, None, True, True, False, "a|2"), (2, 20, None, False, False, False, None)]
    got = outcomes(spark, leaf + inner)
    assert (got[1].n, got[1].errors, got[1].goes_on) == (5, 0, False)
    assert (got[2].n, got[2].errors, got[2].goes_on) == (5, 2, True)


def test_whole_class_failures(spark):
    lost = [(1, 20, b"p", False, False, False, None)] * 4
    top = [(2, 20, None, False, False, False, None)] * 4
    text = [(3, 20, b"p", True, False, False, "no delimiter"), (3, 20, b"p", False, False, False, None)]
    got = outcomes(spark, lost + top + text, max_failed=3, max_failed_top=5)
    assert {t: (r.failed, r.too_many, r.errors) for t, r in got.items()} == {1: (True, True, 4), 2: (True, False, 4), 3: (True, False, 2)}


def test_large_failure_stops_the_run(spark):
    rows = [(1, tag(1), 20, b"p", str(i), False, False, False, None) for i in range(4)]
    checked = sealed.stop_on_large_failures(sealed.class_outcomes(spark.createDataFrame(rows, FLAGS), max_failed=3))
    with pytest.raises(Exception, match="no message opens"):
        checked.collect()


def test_wrong_key_opens_nothing(spark):
    clear = spark.createDataFrame([(1, "m", ["a|1", "b|2"], 2)], "epoch SMALLINT, msg_id STRING, layers ARRAY<STRING>, threshold INT")
    rows = sealed.seal(clear, "s", 2).withColumn("parent_tag", F.lit(None).cast("binary"))
    right = sh.key_of_limbs(sh.key_limbs(prefix_tag(F.lit(1), F.array(F.lit("a|1")), "s"), "s"))
    good = sealed.open_layer(rows.withColumn("key", right)).first()
    assert (good.opened, good.has_next, good.next_opened, good.measurement) == (True, True, True, "a|1")
    bad = sealed.open_layer(rows.withColumn("key", F.unhex(F.lit("00" * 32)))).first()
    assert (bad.opened, bad.has_next, bad.next_opened, bad.measurement) == (False, False, False, None)


def sealed_class(spark, count, first=0):
    """Messages of one class with threshold 20, and their ids: first the 26 that salt 0 samples, by x, then the others."""
    rows = [(1, f"m{at}", ["a|1"], 20) for at in range(first, first + count)]
    clear = spark.createDataFrame(rows, "epoch SMALLINT, msg_id STRING, layers ARRAY<STRING>, threshold INT")
    made = sealed.seal(clear, "s", 1)
    order = made.orderBy(F.xxhash64("x", F.lit(0)), "x").select("x", "msg_id").collect()
    return made, [r.msg_id for r in sorted(order[:26]) + order[26:]]


def altered(frame, ids, column="y"):
    wrong = F.transform("y", lambda limb: F.pmod(limb + F.lit(1), F.lit(P))) if column == "y" else F.reverse(F.hex("ct")).cast("binary")
    return frame.withColumn(column, F.when(F.col("msg_id").isin(ids), wrong).otherwise(F.col(column)))


def processed(spark, messages, pending=None, salt=0):
    """Messages opened, left waiting and lost."""
    none = spark.createDataFrame([], RECOVERED)
    pending = spark.createDataFrame([], sealed.PENDING) if pending is None else pending
    done = sealed.process_batch(messages, none, pending, new_work_folder(spark, "test"), messages.count(), salt=salt)
    opened = sum(r.change for r in done.changes.collect())
    return opened, done.pending, done.quarantine.count()


@pytest.mark.parametrize("places", [(), (0,), (25,), (0, 13), (5, 20), (0, 1, 2, 24, 25)])
def test_bad_shares_lose_no_class(spark, places):
    """Of 26 sampled shares six can be spared: two blocks of three may be bad, wherever they are."""
    messages, order = sealed_class(spark, 60)
    opened, waiting, lost = processed(spark, altered(messages, [order[at] for at in places]))
    assert (opened, waiting.count(), lost) == (60, 0, 0)


def test_a_class_of_bad_shares_waits_for_good_ones(spark):
    messages, order = sealed_class(spark, 60)
    only_bad = altered(messages, order[:60:2])  # half of the sample
    opened, waiting, lost = processed(spark, only_bad)
    assert (opened, waiting.count(), lost) == (0, 60, 0)
    # As few shares as the threshold, one of them bad: nothing can be spared.
    few, order = sealed_class(spark, 20)
    opened, left, lost = processed(spark, altered(few, order[:1]))
    assert (opened, left.count(), lost) == (0, 20, 0)
    # They are opened with the messages of a later batch, whose sample has but few bad shares.
    more, _ = sealed_class(spark, 200, first=1000)
    opened, left, lost = processed(spark, more, left, salt=1)
    assert (opened, left.count(), lost) == (220, 0, 0)


def test_sound_shares_with_broken_messages_fail_as_a_class(spark):
    messages, order = sealed_class(spark, 60)
    opened, waiting, lost = processed(spark, altered(messages, order, "ct"))
    assert (opened, waiting.count(), lost) == (0, 0, 60)
    opened, waiting, lost = processed(spark, altered(messages, order[:59], "ct"))
    assert (opened, waiting.count(), lost) == (60, 0, 0)


def test_the_sample_is_limited_before_its_shuffle(spark):
    messages, _ = sealed_class(spark, 60)
    plan = sealed.share_sample(messages)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit") and "Partial" in plan[plan.rindex("WindowGroupLimit"):]


def test_a_large_batch_is_opened_in_parts(spark, monkeypatch):
    """Parts of whole outer tags: the same as at once, with never more than a part's messages written."""
    rows = [(1, f"m{at}", [f"a|{at % 2}", "b|1"], 20) for at in range(50)] + [(1, f"few{at}", ["a|7"], 20) for at in range(4)]
    clear = spark.createDataFrame(rows, "epoch SMALLINT, msg_id STRING, layers ARRAY<STRING>, threshold INT")
    folder = new_work_folder(spark, "test")
    sealed.seal(clear, "s", 2).write.parquet(f"{folder}/in")
    messages = spark.read.parquet(f"{folder}/in")
    lost = F.col("tag") == prefix_tag(F.lit(1), F.array(F.lit("a|1")), "s")  # none of this tag opens
    messages = messages.withColumn("ct", F.when(lost, F.reverse(F.hex("ct")).cast("binary")).otherwise(F.col("ct")))
    none, pending = spark.createDataFrame([], RECOVERED), spark.createDataFrame([], sealed.PENDING)
    found, most, drop = [], [], sealed.drop_folder

    def counted(session, path):
        if path.endswith(("/parsed", "/opened")):
            most[-1].append(session.read.parquet(path).count())
        drop(session, path)

    monkeypatch.setattr(sealed, "drop_folder", counted)
    for size in (sealed.PART_MESSAGES, 30):
        monkeypatch.setattr(sealed, "PART_MESSAGES", size)
        most.append([])
        done = sealed.process_batch(messages, none, pending, f"{folder}/{size}", len(rows))
        tables = [[str(r) for r in t.select(sorted(t.columns)).collect()] for t in (done.changes, done.pending, done.quarantine)]
        found.append((done.errors, done.rounds, *map(sorted, tables)))
    assert found[0] == found[1] and [len(table) for table in found[0][2:]] == [2, 4, 25]
    assert max(most[0]) == len(rows) and max(most[1]) <= 30


@pytest.mark.parametrize("name", ["altered_shares", "sealed_equals_clear"])
def test_a_run_gets_messages_that_are_not_written(spark, monkeypatch, name):
    class Stopped(Exception):
        pass

    def stop(job, messages, count):
        inputs = [Path(path).parts for path in messages.inputFiles()]
        assert count > 0 and {"ct", "inner"} < set(messages.columns)
        assert not any("inner" in spark.read.parquet(str(Path(*parts[:-1]))).columns for parts in inputs)
        raise Stopped

    monkeypatch.setattr(queries.Aggregation, "run_batch", stop)
    with pytest.raises(Stopped):
        getattr(queries, name)(spark, event_folder(spark, 240))
