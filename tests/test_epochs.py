"""Epoch arithmetic, with a plain Python walk as the expectation."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from veilcount.functions import epochs as ep

NOW = datetime(2024, 3, 10, 12)
WEEK = ep.EpochLength(days=7)


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def at(moment):
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


@pytest.mark.parametrize("epoch,expired", [(2, False), (0, False), (254, False), (253, True), (120, True), (3, True)])
def test_expiry(spark, epoch, expired):
    assert one(spark, ep.is_expired(F.lit(epoch), F.lit(2), 5)) is expired


@pytest.mark.parametrize("epoch,weeks", [(2, 1), (1, 2), (0, 3), (255, 4), (254, 5)])
def test_survey_dates(spark, epoch, weeks):
    next_time = NOW + timedelta(days=7)
    got = one(spark, ep.survey_date(F.lit(epoch), F.lit(2), at(next_time), WEEK))
    assert got == (next_time - timedelta(days=7 * weeks)).date().isoformat()


def test_roll_over(spark):
    clock = ep.rolled_clock(at(NOW), F.lit(255), at(NOW - timedelta(days=14)), WEEK)
    row = one(spark, F.struct(clock["epoch"], F.date_format(clock["next_time"], "yyyy-MM-dd HH").alias("t")))
    assert tuple(row) == (2, (NOW + timedelta(days=7)).strftime("%Y-%m-%d %H"))
    assert one(spark, ep.survey_date(F.lit(255), clock["epoch"], clock["next_time"], WEEK)) == "2024-02-18"
    assert one(spark, ep.survey_date(F.lit(2), clock["epoch"], clock["next_time"], WEEK)) == "2024-03-10"


def test_clock_does_not_go_back(spark):
    clock = ep.rolled_clock(at(NOW), F.lit(9), at(NOW + timedelta(days=30)), WEEK)
    assert one(spark, clock["epoch"]) == 9


def test_months_are_taken_one_by_one(spark):
    month = ep.EpochLength(months=1)
    # From the end of March, two single steps back pass through the end of February.
    assert one(spark, ep.survey_date(F.lit(1), F.lit(2), at(datetime(2024, 3, 31)), month)) == "2024-01-29"
    clock = ep.rolled_clock(at(datetime(2024, 3, 29)), F.lit(0), at(datetime(2024, 1, 31)), month)
    row = one(spark, F.struct(clock["epoch"], F.date_format(clock["next_time"], "yyyy-MM-dd").alias("t")))
    assert tuple(row) == (3, "2024-04-29")


def test_length_is_one_kind_and_not_zero():
    for bad in ({}, {"months": 1, "days": 1}):
        with pytest.raises(ValueError):
            ep.EpochLength(**bad)


def test_epochs_before_the_origin_wrap(spark):
    assert one(spark, ep.epoch_of_time(at(datetime(2023, 12, 31)), datetime(2024, 1, 1), WEEK)) == 255
    assert one(spark, ep.epoch_of_time(at(datetime(2023, 12, 31)), datetime(2024, 1, 1), ep.EpochLength(months=1))) == 255
