"""Grouping, classes and the threshold rule on small tables."""

from pyspark.sql import functions as F

from rows import messages
from veilcount.operators import threshold as th


def revealed(frame):
    return {(r.epoch, tuple(r.prefix)): (r.total, r.is_partial) for r in th.reveal(frame).collect()}


def test_distinct_tags_per_epoch(spark):
    frame = messages(spark, [(0, ["os|a"], 9, 3), (0, ["os|b"], 9, 1), (0, ["os|c"], 9, 8), (7, ["os|a"], 9, 5)])
    counts = th.class_counts(frame)
    assert {r.epoch: r.n for r in counts.groupBy("epoch").agg(F.count("*").alias("n")).collect()} == {0: 3, 7: 1}
    assert counts.agg(F.sum("n")).first()[0] == 17
    assert revealed(frame) == {}


def test_classes_are_not_added_together(spark):
    frame = messages(
        spark,
        [(0, ["a|1"], 20, 30), (0, ["a|1"], 50, 10), (1, ["a|1"], 20, 19), (1, ["a|1"], 50, 49)],
    )
    assert revealed(frame) == {(0, ("a|1",)): (40, False)}


def test_partial_counts_stay_with_the_parent(spark):
    frame = messages(
        spark,
        [(0, ["a|1", "b|1"], 20, 25), (0, ["a|1", "b|2"], 20, 5), (0, ["a|2", "b|1"], 20, 3), (0, ["a|1", "b|3"], 50, 4)],
    )
    assert revealed(frame) == {(0, ("a|1", "b|1")): (25, False), (0, ("a|1",)): (9, True)}


def test_messages_that_end_above_others_are_partial(spark):
    frame = messages(spark, [(0, ["a|1"], 20, 7), (0, ["a|1", "b|1"], 20, 20), (0, [], 20, 50)])
    assert revealed(frame) == {(0, ("a|1", "b|1")): (20, False), (0, ("a|1",)): (7, True)}


def test_thresholds_below_two_open_nothing(spark):
    assert revealed(messages(spark, [(0, ["a|1"], 0, 1), (1, ["a|1"], 1, 9), (2, ["a|1"], 0, 500)])) == {}
    beside = messages(spark, [(0, ["a|1"], 0, 4), (0, ["a|1"], 1, 3), (0, ["a|1"], 5, 5), (0, ["a|1", "b|1"], 1, 2)])
    assert revealed(beside) == {(0, ("a|1",)): (14, True)}


def test_malformed_layers_stay_with_the_layer_above(spark):
    frame = messages(
        spark, [(0, ["a|1", "nothing"], 2, 4), (0, ["a|1", "b|x|y", "c|1"], 2, 4), (0, ["broken"], 2, 9), (0, ["a|1", "b|1"], 2, 2)]
    )
    assert revealed(frame) == {(0, ("a|1",)): (8, True), (0, ("a|1", "b|1")): (2, False)}


def test_class_must_be_new_to_be_recovered(spark):
    schema = "epoch INT, tag STRING, threshold INT, n BIGINT"
    new = spark.createDataFrame([(0, "a", 20, 5), (0, "b", 50, 1), (0, "c", 20, 20), (0, "c", 50, 50), (0, "e", 1, 9)], schema)
    pending = spark.createDataFrame([(0, "a", 20, 15), (0, "b", 20, 40), (0, "d", 20, 30)], schema)
    got = {(r.tag, r.threshold) for r in th.eligible_classes(new, pending, ["epoch", "tag"]).collect()}
    assert got == {("a", 20), ("c", 20), ("c", 50)}


def test_grouping_sets_count_the_same_classes(spark):
    """Chains of one to four layers, empty ones, malformed layers, layers that repeat, and no messages at all."""
    chains = [["a|1"], ["a|1", "b|2"], ["a|1", "b|2", "c|3", "d|4"], ["a|1", "a|1"], ["a|2", "bad", "c|3"], ["bad"], [], ["a|1", "b|"]]
    frame = messages(spark, [(at % 3, layers, 2 + at % 2, 1 + at) for at in range(24) for layers in (chains[at % 8],)])
    listed = lambda rows: sorted((r.epoch, tuple(r.prefix), r.threshold, r.n, r.goes_on) for r in rows.collect())
    assert listed(th.class_counts_by_sets(frame)) == listed(th.class_counts(frame)) != []
    by_sets = th.reveal(frame, th.class_counts_by_sets(frame, 4))
    assert {(r.epoch, tuple(r.prefix)): (r.total, r.is_partial) for r in by_sets.collect()} == revealed(frame) != {}
    assert th.class_counts_by_sets(frame.filter("false")).collect() == []
