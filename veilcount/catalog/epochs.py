"""Epoch arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from veilcount.catalog import sql
from veilcount.functions import epochs as ep
from veilcount.plans import datasets as ds
from veilcount.plans.job import Aggregation, Settings
from veilcount.session import new_work_folder

_MONTH = ep.EpochClock(250, datetime(1996, 1, 31), ep.EpochLength(months=1))
_WEEK = ep.EpochClock(250, datetime(1996, 1, 31, 6), ep.EpochLength(days=7))


def epoch_current(spark, sf):
    """The clock as every order time would have read it, by calendar months and by weeks."""
    rows = ds.table(spark, sf, "orders").select(F.col("o_orderdate").alias("now")).distinct()
    rolled = {
        name: ep.rolled_clock(F.col("now"), clock.epoch_column(), clock.next_column(), clock.length)
        for name, clock in (("month", _MONTH), ("week", _WEEK))
    }
    return rows.withColumns(rolled).select(
        F.date_format("now", "yyyy-MM-dd").alias("now"),
        F.col("month.epoch").alias("month_epoch"),
        F.date_format("month.next_time", "yyyy-MM-dd").alias("month_next"),
        F.col("week.epoch").alias("week_epoch"),
        F.date_format("week.next_time", "yyyy-MM-dd HH").alias("week_next"),
    )


def epoch_expired(spark, sf):
    """Messages by epoch; the current epoch is 2, so 3 and 4 lie ahead and count as expired."""
    counted = ds.event_messages(spark, sf).groupBy("epoch").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("expired", ep.is_expired(F.col("epoch"), F.lit(2), 2))


def survey_date(spark, sf):
    """Start dates of the order months, for a clock that stands at the end of a month, and of weekly epochs."""
    counted = ds.order_messages(spark, sf).groupBy("epoch").agg(F.count(F.lit(1)).alias("n"))
    next_time = F.lit("2001-10-31 00:00:00").cast("timestamp")
    current = F.lit(81)
    return counted.select(
        "epoch",
        "n",
        ep.survey_date(F.col("epoch"), current, next_time, ep.EpochLength(months=1)).alias("by_month"),
        ep.survey_date(F.col("epoch"), current, next_time, ep.EpochLength(days=7)).alias("by_week"),
    )


def epoch_assign(spark, sf):
    rows = ds.table(spark, sf, "orders")
    at = F.col("o_orderdate")
    return rows.groupBy(
        ep.epoch_of_time(at, ds.ORDER_ORIGIN, ep.EpochLength(months=1)).alias("month_epoch"),
        ep.epoch_of_time(at, ds.ORDER_ORIGIN, ep.EpochLength(days=7)).alias("week_epoch"),
    ).agg(F.count(F.lit(1)).alias("n"))


def late_epoch(spark, sf):
    """A quarter of epochs 0 and 1 arrives after their expiry and purge, starts from empty state and still counts."""
    messages = ds.event_messages(spark, sf).select("epoch", "layers", "threshold", "event_id")
    late = (F.col("event_id") % 4 == 0) & (F.col("epoch") <= 1)
    clock = ep.EpochClock(4, datetime(2024, 2, 5), ds.EVENT_EPOCH, 3)
    job = Aggregation(spark, Settings(clock, new_work_folder(spark, "aggregation")), F.lit("2024-01-30").cast("timestamp"))
    for rows in (messages.filter(~late), messages.filter(late)):
        job.run_batch(rows.drop("event_id"), rows.count())
        job.expire()
    names = ("type", "hour", "uid", "k")
    cell = lambda n: F.concat(F.lit(f"{n}|"), F.get_json_object("json", f"$.{n}"))
    shown = job.measurements().select(
        "epoch", F.concat_ws(",", *[cell(n) for n in names]).alias("chain"), "total", (F.col("batch") > 1).alias("late")
    )
    return shown.groupBy("epoch", "chain", "late").agg(F.sum("total").alias("total"))


QUERIES = {
    "epoch_current": epoch_current,
    "epoch_expired": epoch_expired,
    "survey_date": survey_date,
    "epoch_assign": epoch_assign,
    "late_epoch": late_epoch,
}

ORACLES = {
    "epoch_current": """WITH RECURSIVE
months AS (SELECT 0 AS i, TIMESTAMP '1996-01-31' AS t UNION ALL SELECT i + 1, t + INTERVAL 1 MONTH FROM months WHERE i < 300),
weeks AS (SELECT range AS i, TIMESTAMP '1996-01-31 06:00:00' + INTERVAL 7 DAY * range AS t FROM range(1000)),
nows AS (SELECT DISTINCT o_orderdate AS now FROM orders),
m AS (SELECT now, min(i) AS i, min(t) AS t FROM nows JOIN months ON t > now GROUP BY now),
w AS (SELECT now, min(i) AS i, min(t) AS t FROM nows JOIN weeks ON t > now GROUP BY now)
SELECT strftime(m.now, '%Y-%m-%d') AS now, CAST((250 + m.i) % 256 AS SMALLINT) AS month_epoch,
       strftime(m.t, '%Y-%m-%d') AS month_next, CAST((250 + w.i) % 256 AS SMALLINT) AS week_epoch,
       strftime(w.t, '%Y-%m-%d %H') AS week_next
FROM m JOIN w ON m.now = w.now""",
    "epoch_expired": f"""WITH {sql.EVENT_MSGS}
SELECT epoch, count(*) AS n, CASE WHEN epoch <= 2 THEN 2 - epoch ELSE 258 - epoch END >= 2 AS expired
FROM event_msgs GROUP BY epoch""",
    "survey_date": f"""WITH RECURSIVE {sql.ORDER_MSGS},
months AS (SELECT 81 AS e, TIMESTAMP '2001-10-31' - INTERVAL 1 MONTH AS t UNION ALL SELECT e - 1, t - INTERVAL 1 MONTH FROM months WHERE e > 0)
SELECT epoch, count(*) AS n, strftime(any_value(t), '%Y-%m-%d') AS by_month,
       strftime(TIMESTAMP '2001-10-31' - INTERVAL 7 DAY * (82 - epoch), '%Y-%m-%d') AS by_week
FROM order_msgs JOIN months ON epoch = e GROUP BY epoch""",
    "epoch_assign": """SELECT CAST(date_diff('month', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 256 AS SMALLINT) AS month_epoch,
       CAST((date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 7) % 256 AS SMALLINT) AS week_epoch, count(*) AS n
FROM orders GROUP BY ALL""",
    "late_epoch": f"""WITH {sql.EVENT_MSGS},
on_time AS (SELECT * FROM event_msgs WHERE NOT (event_id % 4 = 0 AND epoch <= 1)),
too_late AS (SELECT * FROM event_msgs WHERE event_id % 4 = 0 AND epoch <= 1),{sql.revealed('on_time', 'a')},{sql.revealed('too_late', 'b')}
SELECT epoch, {sql.joined('prefix')} AS chain, total, FALSE AS late FROM a WHERE NOT is_partial OR epoch <= 1
UNION ALL SELECT epoch, {sql.joined('prefix')}, total, TRUE FROM b""",
}
