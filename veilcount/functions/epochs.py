"""Epoch arithmetic as column expressions.

Epochs are numbered 0..255 and wrap. A clock holds the current epoch and the time at which the next one starts. Epoch
lengths are either a fixed time or a number of calendar months. Months are always applied one step at a time, because
adding one month twice and adding two months differ at month ends.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_COUNT = 256


@dataclass(frozen=True)
class EpochLength:
    """Either ``months`` or any mix of ``days`` and ``seconds``."""

    months: int = 0
    days: int = 0
    seconds: int = 0

    def __post_init__(self):
        if bool(self.months) == bool(self.days or self.seconds):
            raise ValueError("an epoch length is either calendar months or a fixed time, and not zero")

    @property
    def micros(self) -> int:
        return (self.days * 86_400 + self.seconds) * 1_000_000


@dataclass(frozen=True)
class EpochClock:
    """Epoch parameters of one channel, as last published."""

    epoch: int
    next_epoch_time: datetime
    length: EpochLength
    lifetime: int = 3
    date_field: str = "wos"

    def next_column(self) -> Column:
        return F.lit(self.next_epoch_time.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    def epoch_column(self) -> Column:
        return F.lit(self.epoch)


def _shift(ts: Column, length: EpochLength, steps: Column) -> Column:
    """``ts`` moved by a signed number of fixed-time epochs."""
    return F.timestamp_micros(F.unix_micros(ts) + steps.cast("bigint") * F.lit(length.micros).cast("bigint"))


def _one_month_step(ts: Column, months: int) -> Column:
    zero = F.lit(0)
    return ts + F.make_interval(zero, F.lit(months), zero, zero, zero, zero, zero)


def _step_numbers(count: Column) -> Column:
    """The array 1..count, empty for zero (``sequence`` alone would count downwards)."""
    return F.slice(F.sequence(F.lit(0), count), F.lit(2), count)


def rolled_clock(now: Column, epoch: Column, next_time: Column, length: EpochLength) -> Column:
    """struct(epoch, next_time) after rolling the clock forward while ``now >= next_time``."""
    if not length.months:
        behind = F.floor((F.unix_micros(now) - F.unix_micros(next_time)) / F.lit(length.micros)) + 1
        steps = F.greatest(behind, F.lit(0).cast("bigint"))
        return F.struct(
            F.pmod(epoch + steps, F.lit(EPOCH_COUNT)).cast("smallint").alias("epoch"),
            _shift(next_time, length, steps).alias("next_time"),
        )
    start = F.struct(epoch.cast("smallint").alias("epoch"), next_time.alias("next_time"))
    # An upper bound for the steps; surplus ones change nothing.
    bound = F.greatest(F.ceil(F.months_between(now, next_time) / length.months) + 2, F.lit(0)).cast("int")

    def roll(clock: Column, _: Column) -> Column:
        later = F.struct(
            F.pmod(clock["epoch"] + 1, F.lit(EPOCH_COUNT)).cast("smallint").alias("epoch"),
            _one_month_step(clock["next_time"], length.months).alias("next_time"),
        )
        return F.when(now >= clock["next_time"], later).otherwise(clock)

    return F.aggregate(_step_numbers(bound), start, roll)


def epoch_distance(current: Column, epoch: Column) -> Column:
    return F.pmod(current.cast("int") - epoch.cast("int"), F.lit(EPOCH_COUNT))


def is_expired(epoch: Column, current: Column, lifetime: int) -> Column:
    """True once the epoch is ``lifetime`` epochs old. A future epoch is 255 old and so expired too."""
    return epoch_distance(current, epoch) >= F.lit(lifetime)


def survey_date(epoch: Column, current: Column, next_time: Column, length: EpochLength) -> Column:
    """ISO date on which ``epoch`` started, counted back from the start of the current epoch."""
    distance = epoch_distance(current, epoch)
    if not length.months:
        return F.date_format(_shift(next_time, length, -(distance + 1)), "yyyy-MM-dd")
    start = _one_month_step(next_time, -length.months)
    moved = F.aggregate(_step_numbers(distance), start, lambda at, _: _one_month_step(at, -length.months))
    return F.date_format(moved, "yyyy-MM-dd")


def epoch_of_time(ts: Column, origin: datetime, length: EpochLength) -> Column:
    """Number of the tumbling epoch that holds ``ts``; epoch 0 starts at ``origin``."""
    start = F.lit(origin.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if length.months:
        passed = F.floor(F.months_between(F.trunc(ts, "month"), F.trunc(start, "month")) / length.months)
    else:
        passed = F.floor((F.unix_micros(ts) - F.unix_micros(start)) / F.lit(length.micros))
    return F.pmod(passed.cast("bigint"), F.lit(EPOCH_COUNT)).cast("smallint")
