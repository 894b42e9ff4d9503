"""Operational summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from veilcount.operators import monitoring
from veilcount.plans import datasets as ds

NOW = "2024-02-01 00:00:00"
# channel, lag threshold, last success, lock-out in seconds
_DUE = (
    ("click", 300, None, 86_400),
    ("view", 10, "2024-01-31 12:00:00", 86_400),
    ("error", 10, "2024-01-30 00:00:00", 172_800),
    ("signup", 1_000_000, None, 0),
    ("purchase", 600, "2024-01-01 00:00:00", 86_400),
)


def timing_summary(spark, sf):
    return monitoring.timing_summary(ds.timings(spark, sf))


def request_counts(spark, sf):
    return monitoring.request_counts(ds.requests(spark, sf))


def latency_histogram(spark, sf):
    return monitoring.latency_histogram(ds.requests(spark, sf))


def consumer_lag(spark, sf):
    return monitoring.consumer_lag(ds.offsets(spark, sf))


def channels_due(spark, sf):
    rows = [(c, t, datetime.fromisoformat(s) if s else None, m) for c, t, s, m in _DUE]
    channels = spark.createDataFrame(
        rows, "channel STRING, lag_threshold BIGINT, last_success TIMESTAMP_NTZ, min_seconds BIGINT"
    ).withColumn("last_success", F.col("last_success").cast("timestamp"))
    lag = monitoring.consumer_lag(ds.offsets(spark, sf))
    return monitoring.channels_due(lag, channels, F.lit(NOW).cast("timestamp"))


QUERIES = {
    "timing_summary": timing_summary,
    "request_counts": request_counts,
    "latency_histogram": latency_histogram,
    "consumer_lag": consumer_lag,
    "channels_due": channels_due,
}

_REQUESTS = """requests AS (
  SELECT 'POST' AS method, '/' || event_type AS path,
         CAST((date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7) % 256 AS SMALLINT) AS epoch,
         CASE WHEN event_id % 19 = 0 THEN 404 WHEN event_id % 23 = 0 THEN 400 ELSE 204 END AS status,
         value / 100 AS seconds
  FROM events)"""
_LAG = f"""lags AS (
  SELECT event_type AS channel,
         count(*) FILTER (user_id % 4 < 3 AND ts >= TIMESTAMP '{ds.COMMITTED_AT}') AS lag FROM events GROUP BY event_type)"""
_SETTINGS = ", ".join(
    f"('{c}', {t}, {'NULL' if s is None else f'TIMESTAMP {chr(39)}{s}{chr(39)}'}, {m})" for c, t, s, m in _DUE
)

ORACLES = {
    "timing_summary": """WITH t AS (SELECT event_type AS stat, CAST(round(value * 100) AS BIGINT) AS ms FROM events),
l AS (SELECT stat, list_sort(list(ms)) AS v FROM t GROUP BY stat)
SELECT stat, v[1] AS min, """ + ", ".join(
        f"v[CAST(floor(CAST(len(v) AS FLOAT) * CAST({p} AS FLOAT)) AS BIGINT) + 1] AS p{round(p * 100)}"
        for p in monitoring.PERCENTILES
    ) + """, v[len(v)] AS max, CAST(list_sum(v) AS BIGINT) AS sum, len(v) AS count FROM l""",
    "request_counts": f"""WITH {_REQUESTS}
SELECT method, path, epoch, status, count(*) AS requests FROM requests WHERE status <> 404 GROUP BY ALL""",
    "latency_histogram": f"""WITH {_REQUESTS},
bounds AS (SELECT * FROM (VALUES {', '.join(f"('{b}', CAST({b} AS DOUBLE))" for b in monitoring.LATENCY_BOUNDS)},
  ('+Inf', CAST('Infinity' AS DOUBLE))) v(le, b))
SELECT method, path, status, le, count(*) AS count, count(*) FILTER (seconds <= b) AS requests,
       CAST(sum(CAST(round(seconds * 1000000) AS BIGINT)) AS BIGINT) AS sum_micros
FROM requests, bounds WHERE status <> 404 GROUP BY ALL""",
    "consumer_lag": f"WITH {_LAG} SELECT channel, lag FROM lags",
    "channels_due": f"""WITH {_LAG},
c AS (SELECT * FROM (VALUES {_SETTINGS}) v(channel, t, s, m))
SELECT lags.channel, lag, lag >= t AND (s IS NULL OR TIMESTAMP '{NOW}' >= s + INTERVAL 1 SECOND * m) AS due
FROM lags JOIN c ON lags.channel = c.channel""",
}
