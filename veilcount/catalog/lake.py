"""The JSON-lines lake."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilcount.catalog import sql
from veilcount.catalog.state import event_job
from veilcount.operators import monitoring, threshold as th
from veilcount.plans import datasets as ds
from veilcount.session import new_work_folder
from veilcount.sinks import lake
from veilcount.streaming.counts import landed_counts, start_counts
from veilcount.streaming.flushing import start_flushing_sink
from veilcount.streaming.lake_sink import start_lake_sink
from veilcount.streaming.progress import ProgressLog

# The tables hold one record every few minutes, so the flush rules are scaled to that.
IDLE, SIZE = 300, 20
DATE = "2024-02-01"
DATED = ["click", "view"]


def _field(name, path=None):
    return F.get_json_object("line", f"$.{path or name}").alias(name)


def _measurement_lines(messages, *by):
    """One JSON line per equal chain."""
    names = ("flag", "status", "disc", "qty")
    cells = [F.split(F.get("layers", F.lit(i)), "[|]").getItem(1).alias(n) for i, n in enumerate(names)]
    counted = messages.groupBy("epoch", "layers", *by).agg(F.count(F.lit(1)).alias("total"))
    return counted.select(
        F.concat(F.lit("epoch"), "epoch").alias("channel"), F.to_json(F.struct(*cells, "epoch", "total")).alias("line"), *by
    )


def lake_jsonl(spark, sf):
    folder = new_work_folder(spark, "lake")
    lake.write_jsonl(_measurement_lines(ds.lineitem_messages(spark, sf)), folder, F.lit(DATE))
    rows = lake.read_jsonl(spark, folder)
    return rows.select(
        "date", "channel", _field("flag"), _field("status"), _field("disc"), _field("qty"),
        _field("total").cast("bigint").alias("total"),
    )


def lake_rollup(spark, sf):
    """The same chains are reported in three flushes; a reader sums them."""
    folder = new_work_folder(spark, "lake")
    lines = _measurement_lines(ds.lineitem_messages(spark, sf), "batch")
    for number in range(3):
        lake.write_jsonl(lines.filter(F.col("batch") == number), folder, F.lit(DATE))
    schema = "flag STRING, status STRING, disc STRING, qty STRING, epoch INT, total BIGINT"
    rows = lake.read_jsonl(spark, folder).select("date", F.from_json("line", schema).alias("m")).select("date", "m.*")
    return lake.rollup(rows, ["date", "epoch", "flag", "status", "disc", "qty"])


def _odd_lines(spark, sf):
    number = F.col("event_id")
    line = (
        F.when(number % 7 == 1, F.concat(F.lit('{"ymd":"old","k":'), number, F.lit("}")))
        .when(number % 7 == 2, F.lit(" \t"))
        .when(number % 7 == 3, F.concat(F.lit("["), number, F.lit(",2]")))
        .when(number % 7 == 4, F.lit('"text"'))
        .otherwise(F.col("props"))
    )
    return ds.table(spark, sf, "events").select("event_id", F.col("event_type").alias("channel"), line.alias("line"))


def lake_ymd(spark, sf):
    lines = lake.with_date_field(_odd_lines(spark, sf), F.lit(DATE), DATED)
    is_object = F.col("line").startswith("{")
    return lines.select(
        "event_id", "channel", _field("k"), _field("ymd"), F.when(~is_object, F.col("line")).alias("other")
    )


def lake_batches(spark, sf):
    rows = lake.flush_batches(ds.lake_records(spark, sf), IDLE, SIZE)
    return rows.select("channel", "record_id", "session", "batch")


def lake_progress(spark, sf):
    rows = lake.flush_batches(ds.lake_records(spark, sf), IDLE, SIZE)
    return monitoring.lake_progress(rows, F.lit("2024-01-30 23:59:00").cast("timestamp"), IDLE, SIZE)


def records_to_lake(spark, sf):
    """Records through a whole run of bounded batches, its measurements into the lake, and summed there."""
    folder = new_work_folder(spark, "lake")
    job = event_job(spark, ds.records(spark, sf))
    for batch in sorted(row.batch for row in job.measurements().select("batch").distinct().collect()):
        lake.write_jsonl(lake.measurement_lines(job.measurements().filter(F.col("batch") == batch), "events"), folder, F.lit(DATE))
    schema = "type STRING, hour STRING, uid STRING, k STRING, wos STRING, total BIGINT"
    rows = lake.read_jsonl(spark, folder).select("date", "channel", F.from_json("line", schema).alias("m"))
    summed = lake.rollup(rows.select("date", "channel", "m.*"), ["date", "channel", "type", "hour", "uid", "k", "wos"])
    return summed.drop("reports").filter("total > 0")


def stream_lake(spark, sf):
    """The events table as a stream into the lake, read back."""
    folder, checkpoint = new_work_folder(spark, "lake"), new_work_folder(spark, "progress")
    stream = ds.table_stream(spark, sf, "events")
    lines = stream.select(
        F.col("event_type").alias("channel"), F.to_json(F.struct("event_id", "user_id")).alias("line")
    )
    start_lake_sink(lines, folder, checkpoint, DATED, available_now=True, today=lambda: DATE).awaitTermination()
    return lake.read_jsonl(spark, folder).select(
        "date", "channel", _field("event_id").cast("bigint").alias("event_id"),
        _field("user_id").cast("bigint").alias("user_id"), _field("ymd"),
    )


def topic_once(spark, sf):
    """All measurements of a whole run as keyed records, landed twice as after a failed write, read once and summed."""
    measurements = event_job(spark, ds.records(spark, sf)).measurements()
    folder = new_work_folder(spark, "topic")
    for _ in range(2):
        lake.topic_records(measurements, "events").write.mode("append").parquet(folder)
    schema = "type STRING, hour STRING, uid STRING, k STRING, wos STRING, total BIGINT"
    rows = lake.kept_once(spark.read.parquet(folder)).select(F.from_json(F.col("value").cast("string"), schema).alias("m"))
    return lake.rollup(rows.select("m.*"), ["type", "hour", "uid", "k", "wos"]).drop("reports").filter("total > 0")


def _land_and_run(rows, folder, cuts, run):
    """Land the rows in parts, one for each cut and the rest, with a run after each part."""
    rest = F.lit(True)
    for cut in cuts:
        rows.filter(rest & cut).write.mode("append").parquet(folder)
        rest = rest & ~cut
        run()
    rows.filter(rest).write.mode("append").parquet(folder)
    run()


def stream_flushes(spark, sf):
    """Stored flushes of the events as a stream that arrives in three parts and is started anew for each."""
    source, folder, progress, stored = (new_work_folder(spark, n) for n in ("source", "flushing", "progress", "stored"))
    rows = ds.lake_records(spark, sf)

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(source)
        store = lambda closed, number: closed.write.mode("overwrite").parquet(f"{stored}/batch={number}")
        start_flushing_sink(stream, folder, progress, store, IDLE, SIZE, available_now=True).awaitTermination()

    _land_and_run(rows, source, [F.col("ts") < F.lit(day).cast("timestamp") for day in ("2024-01-09", "2024-01-21")], run)
    found = spark.read.schema("channel STRING, record_id BIGINT, session BIGINT, flush BIGINT").parquet(stored)
    return found.select("channel", "record_id", "session", F.col("flush").alias("batch"))


def stream_progress(spark, sf):
    """Records that a run of the flush rule has received, stored and still holds, from the progress that it landed."""
    folder, checkpoint, stored = (new_work_folder(spark, n) for n in ("flushing", "progress", "stored"))
    log = ProgressLog(spark, new_work_folder(spark, "listened"))
    rows, source = ds.lake_records(spark, sf), new_work_folder(spark, "source")
    spark.streams.addListener(log)
    try:
        def run():
            stream = spark.readStream.schema(rows.schema).parquet(source)
            store = lambda closed, number: closed.write.mode("overwrite").parquet(f"{stored}/batch={number}")
            query = start_flushing_sink(stream, folder, checkpoint, store, IDLE, SIZE, available_now=True)
            query.awaitTermination()
            log.wait(query)

        _land_and_run(rows, source, [F.col("ts") < F.lit("2024-01-15").cast("timestamp")], run)
    finally:
        spark.streams.removeListener(log)
    kept = spark.read.schema("channel STRING, record_id BIGINT").parquet(stored)
    saved = kept.agg(F.count(F.lit(1)).alias("saved")).withColumn("name", F.lit("flushing"))
    return monitoring.stream_progress(log.rows().withColumn("name", F.lit("flushing")), saved).drop("name")


def stream_threshold(spark, sf):
    """The threshold aggregation of the events as a stateful stream, which arrives in three parts by number."""
    source, folder, progress = (new_work_folder(spark, n) for n in ("source", "classes", "progress"))
    rows = ds.event_messages(spark, sf).withColumn(
        "epoch_end", F.lit(str(ds.EVENT_ORIGIN)).cast("timestamp") + F.make_dt_interval((F.col("epoch") + 1) * 7)
    )

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(source)
        start_counts(stream, folder, progress, "365 days", available_now=True).awaitTermination()

    _land_and_run(rows, source, [F.col("event_id") % 3 == 0, F.col("event_id") % 3 == 1], run)
    revealed = th.reveal(None, landed_counts(spark, folder))
    return revealed.select("epoch", F.size("prefix").alias("depth"), F.array_join("prefix", ",").alias("chain"), "total", "is_partial")


QUERIES = {
    "topic_once": topic_once,
    "stream_flushes": stream_flushes,
    "stream_progress": stream_progress,
    "stream_threshold": stream_threshold,
    "lake_jsonl": lake_jsonl,
    "lake_rollup": lake_rollup,
    "lake_ymd": lake_ymd,
    "lake_batches": lake_batches,
    "lake_progress": lake_progress,
    "records_to_lake": records_to_lake,
    "stream_lake": stream_lake,
}

_CELLS = ", ".join(f"split_part(layers[{i}], '|', 2) AS {n}" for i, n in enumerate(("flag", "status", "disc", "qty"), 1))
_DATED = "event_type IN ('click', 'view')"
_BATCHES = f"""
g AS (SELECT event_type AS channel, event_id AS record_id, ts,
             ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) > INTERVAL {IDLE} SECOND AS starts FROM events),
s AS (SELECT *, CAST(sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY ts, record_id) AS BIGINT) AS session FROM g),
b AS (SELECT *, (row_number() OVER (PARTITION BY channel, session ORDER BY ts, record_id) - 1) // {SIZE} AS batch FROM s)"""

_REPORTED_ROWS = f"""WITH {sql.EVENT_MSGS},
typed AS (
  SELECT epoch, layers, CASE event_id % 13 WHEN 0 THEN 50 WHEN 1 THEN 0 WHEN 2 THEN 50 WHEN 3 THEN 50 WHEN 4 THEN 306 ELSE 20 END AS threshold
  FROM event_msgs),{sql.revealed('typed')}"""
_REPORTED = """split_part(prefix[1], '|', 2) AS type,
       CASE WHEN len(prefix) > 1 THEN split_part(prefix[2], '|', 2) END AS hour,
       CASE WHEN len(prefix) > 2 THEN split_part(prefix[3], '|', 2) END AS uid,
       CASE WHEN len(prefix) > 3 THEN split_part(prefix[4], '|', 2) END AS k,
       strftime(DATE '2024-01-01' + CAST(epoch AS INTEGER) * 7, '%Y-%m-%d') AS wos, total
FROM revealed WHERE NOT is_partial OR 4 - epoch >= 3"""

ORACLES = {
    "lake_jsonl": f"""WITH {sql.LINEITEM_MSGS}
SELECT '{DATE}' AS date, 'epoch' || CAST(epoch AS VARCHAR) AS channel, {_CELLS}, count(*) AS total FROM line_msgs GROUP BY ALL""",
    "lake_rollup": f"""WITH {sql.LINEITEM_MSGS}
SELECT '{DATE}' AS date, CAST(epoch AS INTEGER) AS epoch, {_CELLS}, count(*) AS total, count(DISTINCT batch) AS reports
FROM line_msgs GROUP BY ALL""",
    "lake_ymd": f"""WITH l AS (
  SELECT event_id, event_type, CASE event_id % 7 WHEN 1 THEN '{{"ymd":"old","k":' || CAST(event_id AS VARCHAR) || '}}'
         WHEN 2 THEN ' ' || chr(9) WHEN 3 THEN '[' || CAST(event_id AS VARCHAR) || ',2]' WHEN 4 THEN '"text"' ELSE props END AS line
  FROM events)
SELECT event_id, event_type AS channel, CASE WHEN line LIKE '{{%' THEN json_extract_string(line, '$.k') END AS k,
       CASE WHEN line LIKE '{{%' THEN CASE WHEN {_DATED} THEN '{DATE}' WHEN event_id % 7 = 1 THEN 'old' END END AS ymd,
       CASE WHEN line NOT LIKE '{{%' THEN line END AS other
FROM l WHERE NOT ({_DATED} AND event_id % 7 = 2)""",
    "lake_batches": f"WITH {_BATCHES} SELECT channel, record_id, session, batch FROM b",
    "lake_progress": f"""WITH {_BATCHES},
z AS (SELECT channel, session, batch, count(*) AS n, max(ts) AS last FROM b GROUP BY ALL),
q AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY session DESC, batch DESC) = 1 AND n < {SIZE}
             AND NOT (TIMESTAMP '2024-01-30 23:59:00' - last > INTERVAL {IDLE} SECOND) AS is_open FROM z)
SELECT channel, CAST(sum(CASE WHEN is_open THEN 0 ELSE n END) AS BIGINT) AS saved,
       CAST(sum(CASE WHEN is_open THEN n ELSE 0 END) AS BIGINT) AS waiting FROM q GROUP BY channel""",
    "records_to_lake": f"""{_REPORTED_ROWS}
SELECT '{DATE}' AS date, 'events' AS channel, {_REPORTED}""",
    "topic_once": f"{_REPORTED_ROWS} SELECT {_REPORTED}",
    "stream_flushes": f"""WITH {_BATCHES},
z AS (SELECT channel, session, batch, count(*) AS n, max(ts) AS last FROM b GROUP BY ALL),
q AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY session DESC, batch DESC) = 1 AND n < {SIZE}
             AND NOT ((SELECT max(ts) FROM events) - last > INTERVAL {IDLE} SECOND) AS is_open FROM z)
SELECT channel, record_id, session, batch FROM b WHERE (channel, session, batch) NOT IN (SELECT (channel, session, batch) FROM q WHERE is_open)""",
    "stream_threshold": f"""WITH {sql.EVENT_MSGS},{sql.revealed('event_msgs')}
SELECT epoch, CAST(len(prefix) AS INTEGER) AS depth, {sql.joined('prefix')} AS chain, total, is_partial FROM revealed""",
    "stream_lake": f"""SELECT '{DATE}' AS date, event_type AS channel, event_id, user_id,
       CASE WHEN {_DATED} THEN '{DATE}' END AS ymd FROM events""",
}
ORACLES["stream_progress"] = f"""SELECT (SELECT count(*) FROM events) AS received, count(*) AS saved,
       (SELECT count(*) FROM events) - count(*) AS waiting FROM ({ORACLES['stream_flushes']}) f"""
