"""Reports on small trees."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from rows import recovered, tag
from veilcount.functions.epochs import EpochClock, EpochLength
from veilcount.functions.measurements import measurement_json
from veilcount.operators import report

CLOCK = EpochClock(2, datetime(2024, 1, 8), EpochLength(days=7))


def emitted(frame, epoch=2):
    now = F.lit("2024-01-03").cast("timestamp")
    rows = report.measurements(frame.filter(F.col("epoch") == epoch), CLOCK, now).collect()
    return sorted((json.loads(r.json) for r in rows), key=str)


def left(frame, rows):
    return {(r.epoch, r.tag[0]): r["count"] for r in report.residual_counts(rows, frame).collect()}


# Two epochs; in epoch 2 a tree of one root with three branches, the middle one two levels deep.
TREE = [
    (11, 1, "os", "mac", None, 40, False),
    (11, 2, "os", "mac", None, 90, True),
    (12, 2, "lang", "fi", 11, 31, False),
    (13, 2, "lang", "pt", 11, 44, True),
    (14, 2, "lang", "el", 11, 3, False),
    (15, 2, "tier", "basic", 13, 26, False),
    (16, 2, "tier", "extra", 13, 13, False),
]


def test_full_report(spark):
    rows = recovered(spark, TREE)
    out = report.full_report(rows).filter("epoch = 2")
    assert emitted(out) == sorted(
        [
            {"os": "mac", "lang": "fi", "total": 31, "wos": "2024-01-01"},
            {"os": "mac", "lang": "el", "total": 3, "wos": "2024-01-01"},
            {"os": "mac", "lang": "pt", "tier": "basic", "total": 26, "wos": "2024-01-01"},
            {"os": "mac", "lang": "pt", "tier": "extra", "total": 13, "wos": "2024-01-01"},
        ],
        key=str,
    )
    assert left(out, rows) == {(1, 11): 40, (2, 11): 17, (2, 12): 0, (2, 13): 5, (2, 14): 0, (2, 15): 0, (2, 16): 0}


def test_partial_report(spark):
    """What is left after the full report: the root's own messages and those of the middle branch."""
    counts = {11: 17, 12: 0, 13: 5, 14: 0, 15: 0, 16: 0}
    rows = recovered(spark, [(*row[:5], counts[row[0]], row[6]) for row in TREE if row[1] == 2])
    out = report.partial_report(rows)
    assert emitted(out) == [
        {"os": "mac", "lang": "pt", "total": 5, "wos": "2024-01-01"},
        {"os": "mac", "total": 12, "wos": "2024-01-01"},
    ]
    assert set(left(out, rows).values()) == {0}


def test_zero_row_hides_what_is_below(spark):
    rows = recovered(
        spark,
        [(51, 2, "a", "1", None, 0, True), (52, 2, "b", "2", 51, 5, False), (53, 2, "a", "2", None, 4, False)],
    )
    assert [r["total"] for r in report.full_report(rows).collect()] == [4]


def test_row_marked_as_leaf_hides_what_is_below(spark):
    rows = recovered(spark, [(51, 2, "a", "1", None, 9, False), (52, 2, "b", "2", 51, 5, False)])
    assert [r["total"] for r in report.full_report(rows).collect()] == [9]


def test_reserved_names_win(spark):
    chain = F.from_json(
        F.lit('[{"name":"total","value":"x"},{"name":"a","value":"1"},{"name":"wos","value":"y"},{"name":"a","value":"2"}]'),
        "ARRAY<STRUCT<name: STRING, value: STRING>>",
    )
    one = lambda field: json.loads(
        spark.range(1).select(measurement_json(chain, F.lit(3).cast("bigint"), field, F.lit("2024-01-01"))).first()[0]
    )
    assert one("wos") == {"a": "2", "total": 3, "wos": "2024-01-01"}
    assert one("total") == {"a": "2", "wos": "y", "total": "2024-01-01"}


def test_expired_rows(spark):
    rows = recovered(spark, [(51, e, "a", "1", None, 1, False) for e in (2, 1, 0, 255, 254, 3)])
    out = report.expired_rows(rows, CLOCK, F.lit("2024-01-03").cast("timestamp"))
    assert {r.epoch for r in out.collect()} == {255, 254, 3}


def test_tag_is_kept(spark):
    assert {bytes(r.tag) for r in report.full_report(recovered(spark, TREE)).collect()} == {tag(n) for n in (11, 12, 14, 15, 16)}
