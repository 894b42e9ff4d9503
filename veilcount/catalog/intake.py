"""Intake, records and message sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilcount.catalog import sql
from veilcount.functions.text import base64_text, split_measurement, unsigned_header
from veilcount.operators import state, threshold as th
from veilcount.plans import datasets as ds
from veilcount.session import new_work_folder
from veilcount.sources import intake, records as rec, synth
from veilcount.streaming.intake import start_intake


def _channels(spark):
    return intake.channel_table(spark, [intake.Channel(n, r) for n, r in ds.CHANNELS.items()])


def intake_decode(spark, sf):
    decoded = intake.decode_body(ds.submissions(spark, sf))
    return decoded.select("event_id", F.col("text").isNotNull().alias("utf8_ok"), F.hex("data").alias("data"))


def envelope_parse(spark, sf):
    message = intake.parse_envelope(F.col("data"))
    parsed = intake.decode_body(ds.submissions(spark, sf)).withColumn("message", message)
    return parsed.select(
        "event_id", F.col("message.epoch").alias("epoch"), F.array_join("message.layers", ",").alias("chain")
    )


def channel_route(spark, sf):
    routed = intake.route(ds.submissions(spark, sf), _channels(spark), ds.MAIN_CHANNEL)
    return routed.select("event_id", "channel", "known")


def min_revision(spark, sf):
    routed = intake.route(ds.submissions(spark, sf), _channels(spark), ds.MAIN_CHANNEL)
    old = intake.old_client(F.col("revision"), F.col("min_revision"))
    return routed.filter("known").select("event_id", "channel", old.alias("ignored"))


def threshold_range(spark, sf):
    return ds.submissions(spark, sf).select(
        "event_id",
        unsigned_header(F.col("threshold")).cast("bigint").alias("request_threshold"),
        intake.bad_threshold(F.col("threshold")).alias("rejected"),
    )


def intake_status(spark, sf):
    rows = intake.classify(ds.submissions(spark, sf), _channels(spark), ds.MAIN_CHANNEL)
    return rows.select(
        "event_id", "channel", "status", "accepted", F.when(F.col("accepted"), F.col("message.epoch")).alias("epoch")
    )


def accepted_records(spark, sf):
    """Accepted submissions turned into records and read back as messages."""
    rows = intake.classify(ds.submissions(spark, sf), _channels(spark), ds.MAIN_CHANNEL)
    return _by_chain(intake.to_records(rows))


def stream_intake(spark, sf):
    """The same from a stream of submissions, through landed records."""
    folder, checkpoint = new_work_folder(spark, "records"), new_work_folder(spark, "progress")
    stream = ds.submissions_of_events(ds.table_stream(spark, sf, "events"))
    start_intake(stream, _channels(spark), ds.MAIN_CHANNEL, folder, checkpoint, available_now=True).awaitTermination()
    return _by_chain(spark.read.parquet(folder))


def _by_chain(records):
    made = records.withColumns({"partition": F.lit(0), "offset": F.lit(0)})
    return rec.to_messages(made).groupBy(
        "channel", F.col("message.epoch").alias("epoch"), F.array_join("message.layers", ",").alias("chain"), "threshold"
    ).agg(F.count(F.lit(1)).alias("n"))


def read_records(spark, sf):
    """Everything after the committed offsets, parsed."""
    unread = rec.bounded_batch(rec.Landed(ds.records(spark, sf)), {p: 100 * p for p in range(1, 4)}, limit=2**40)
    return rec.to_messages(unread.records).select(
        "partition",
        "offset",
        F.col("message.epoch").alias("epoch"),
        F.array_join("message.layers", ",").alias("chain"),
        "threshold",
    )


def header_threshold(spark, sf):
    return rec.with_threshold(ds.records(spark, sf)).select("partition", "offset", "threshold")


def bounded_batch(spark, sf):
    """All records in batches of a tenth: every one in exactly one batch, over uneven partitions with gaps.

    Partition 0 starts late, partition 1 lacks every other stretch of 64 offsets, partition 3 is only found by reading.
    """
    uneven = _uneven(ds.records(spark, sf)).select("partition", "offset")
    total = uneven.count()
    source, committed, parts = rec.Landed(uneven), {0: 0, 1: 0, 2: 0}, []
    while True:
        batch = rec.bounded_batch(source, committed, limit=-(-total // 10))
        if not batch.waiting:
            break
        parts.append(batch.records.withColumn("batch", F.lit(len(parts))))
        committed = batch.next_offsets
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    by_row = rows.groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("times"))
    return by_row.groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"), F.max("times").alias("times"), F.max("offset").alias("last_offset")
    )


def _uneven(records):
    late = (F.col("partition") != 0) | (F.col("offset") >= 50)
    holes = (F.col("partition") != 1) | (F.floor(F.col("offset") / 64) % 2 == 1)
    few = (F.col("partition") != 2) | (F.col("offset") % 5 == 0)
    return records.filter(late & holes & few)


def arrival_rate(spark, sf):
    """The table's clock is scaled: 600 seconds count as one."""
    rows = rec.arrival_rate(ds.records(spark, sf), frame_seconds=3_000, ticks=5, min_rate=2)
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "messages", "low")


def csv_layers(spark, sf):
    folder = new_work_folder(spark, "csv")
    cell = lambda c: F.concat(F.lit("  "), F.col(c), F.lit(" "))
    size = F.when(F.col("p_size") % 7 == 0, F.lit("   ")).otherwise(F.col("p_size").cast("string"))
    counted = (
        ds.table(spark, sf, "part")
        .groupBy(cell("p_brand").alias("brand"), cell("p_type").alias("type"), size.alias("size"))
        .agg(F.count(F.lit(1)).alias("total"))
    )
    counted.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
        folder, header=True
    )
    rows = synth.repeat(synth.csv_measurements(spark, folder))
    return rows.groupBy(F.array_join("layers", ",").alias("chain")).agg(F.count(F.lit(1)).alias("n"))


def synth_messages(spark, sf):
    """50 equal messages per customer; every set is recovered in full."""
    rows = synth.generated_messages(ds.table(spark, sf, "customer"), "c_custkey")
    revealed = th.reveal(rows.select(F.lit(1).cast("smallint").alias("epoch"), "layers", F.lit(50).alias("threshold")))
    return revealed.select("epoch", F.array_join("prefix", ",").alias("chain"), "total", "is_partial")


def message_file(spark, sf):
    folder = new_work_folder(spark, "lines")
    ds.records(spark, sf).select(base64_text(F.col("value")).alias("value")).write.text(folder)
    lines = intake.decode_body(synth.message_lines(spark, folder))
    message = lines.withColumn("message", intake.parse_envelope(F.col("data")))
    return message.groupBy(
        F.col("message.epoch").alias("epoch"), F.array_join("message.layers", ",").alias("chain")
    ).agg(F.count(F.lit(1)).alias("n"))


def _odd_texts(spark, sf):
    number = F.col("event_id")
    nul = F.char(F.lit(0))
    text = (
        F.when(number % 5 == 1, F.concat(F.lit("type|"), "event_type", F.lit("|x")))
        .when(number % 5 == 2, F.concat(F.lit("type"), "event_type"))
        .when(number % 5 == 3, F.concat(F.lit("type|"), nul, "event_type", nul, nul))
        .when(number % 5 == 4, F.concat(F.lit("|"), "props"))
        .otherwise(F.concat(F.lit("type|"), "event_type"))
    )
    return ds.table(spark, sf, "events").select("event_id", text.alias("text"))


def split_measurements(spark, sf):
    parts = split_measurement(F.col("text"))
    return _odd_texts(spark, sf).select("event_id", parts["name"].alias("name"), parts["value"].alias("value"))


def bounds_check(spark, sf):
    rows = ds.table(spark, sf, "documents").withColumn("threshold", F.col("n_chars") * 10)
    fits = state.within_bounds(F.concat("source", F.lit("/"), "lang"), F.col("text"), F.col("threshold"))
    return rows.select("doc_id", fits.alias("fits"))


QUERIES = {
    "intake_decode": intake_decode,
    "envelope_parse": envelope_parse,
    "channel_route": channel_route,
    "min_revision": min_revision,
    "threshold_range": threshold_range,
    "intake_status": intake_status,
    "accepted_records": accepted_records,
    "stream_intake": stream_intake,
    "read_records": read_records,
    "header_threshold": header_threshold,
    "bounded_batch": bounded_batch,
    "arrival_rate": arrival_rate,
    "csv_layers": csv_layers,
    "synth_messages": synth_messages,
    "message_file": message_file,
    "split_measurement": split_measurements,
    "bounds_check": bounds_check,
}

_ENVELOPE = """'{"epoch":' || CAST(epoch AS VARCHAR) || ',"layers":["' || array_to_string(layers, '","') || '"]}'"""
_UNSIGNED = "CASE WHEN regexp_full_match({0}, '[+]?[0-9]+') THEN TRY_CAST(ltrim({0}, '+') AS HUGEINT) END"
_MIN = "CASE channel " + " ".join(
    f"WHEN '{n}' THEN {r}" for n, r in ds.CHANNELS.items() if r is not None
) + " END"
_KNOWN = "channel IN (" + ", ".join(f"'{n}'" for n in ds.CHANNELS) + ")"

SUBMISSIONS = f"""{sql.EVENT_MSGS},
sub_e AS (SELECT *, {_ENVELOPE} AS envelope FROM event_msgs),
sub_t AS (
  SELECT *, CASE WHEN event_id % 43 = 2 THEN left(envelope, length(envelope) - 3)
                 WHEN event_id % 53 = 4 THEN regexp_replace(envelope, '"epoch":[0-9]+', '"epoch":300')
                 WHEN event_id % 59 = 6 THEN '{{"epoch":1}}' ELSE envelope END AS txt FROM sub_e),
sub_b AS (SELECT *, to_base64(encode(txt)) AS enc FROM sub_t),
subs AS (
  SELECT event_id,
         coalesce(CASE WHEN event_id % 47 = 0 THEN 'nosuch' WHEN event_id % 5 <> 0 THEN event_type END, '{ds.MAIN_CHANNEL}') AS channel,
         CASE WHEN event_id % 29 = 3 THEN encode(left(enc, length(enc) - 1))
              WHEN event_id % 31 = 5 THEN encode(substr(enc, 1, 8) || chr(10) || substr(enc, 9))
              WHEN event_id % 37 = 7 THEN unhex('FF') || encode(enc)
              WHEN event_id % 41 = 1 THEN encode('  ' || chr(10) || enc || ' ' || chr(9) || chr(13) || chr(10))
              ELSE encode(enc) END AS body,
         CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN '+4' WHEN 3 THEN ' 12'
              ELSE CAST(event_id % 7 AS VARCHAR) END AS revision,
         CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '19' WHEN 3 THEN '51' WHEN 4 THEN '+20'
              WHEN 5 THEN '50' WHEN 6 THEN '30 ' ELSE CAST(20 + event_id % 31 AS VARCHAR) END AS threshold
  FROM sub_b),
sub_x AS (SELECT *, regexp_replace(TRY(decode(body)), '^[\\s\\x0B\\pZ]+|[\\s\\x0B\\pZ]+$', '', 'g') AS t FROM subs),
sub_d AS (
  SELECT *, CASE WHEN regexp_full_match(t, '([A-Za-z0-9+/]{{4}})*([A-Za-z0-9+/]{{2}}==|[A-Za-z0-9+/]{{3}}=)?')
                  AND to_base64(from_base64(t)) = t THEN from_base64(t) END AS data,
         {_KNOWN} AS known, {_MIN} AS min_revision,
         {_UNSIGNED.format('revision')} AS rev, {_UNSIGNED.format('threshold')} AS thr FROM sub_x),
sub_p AS (
  SELECT *, CASE WHEN data IS NOT NULL AND json_valid(decode(data)) THEN decode(data) END AS j FROM sub_d),
sub_m AS (
  SELECT *, CASE WHEN CAST(json_extract_string(j, '$.epoch') AS INTEGER) BETWEEN 0 AND 255
                  AND json_array_length(j, '$.layers') > 0
                 THEN CAST(json_extract_string(j, '$.epoch') AS INTEGER) END AS epoch,
         CASE WHEN CAST(json_extract_string(j, '$.epoch') AS INTEGER) BETWEEN 0 AND 255
              THEN array_to_string(CAST(json_extract(j, '$.layers') AS VARCHAR[]), ',') END AS chain,
         coalesce(rev, 0) < min_revision AS is_old, coalesce(thr NOT BETWEEN 20 AND 50, FALSE) AS bad_thr
  FROM sub_p),
sub_s AS (
  SELECT *, CASE WHEN NOT known THEN 404 WHEN epoch IS NULL THEN 400 WHEN coalesce(is_old, FALSE) THEN 204
                 WHEN bad_thr THEN 400 ELSE 204 END AS status,
         known AND epoch IS NOT NULL AND NOT coalesce(is_old, FALSE) AND NOT bad_thr AS accepted
  FROM sub_m)"""

_RECORDS = f"""{sql.EVENT_MSGS},
recs AS (
  SELECT epoch, layers, ts, event_id, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset",
         CAST(CASE event_id % 13 WHEN 0 THEN 50 WHEN 1 THEN 0 WHEN 2 THEN 50 WHEN 3 THEN 50 WHEN 4 THEN 306 ELSE 20 END AS BIGINT) AS threshold
  FROM event_msgs)"""

ORACLES = {
    "intake_decode": f"WITH {SUBMISSIONS} SELECT event_id, t IS NOT NULL AS utf8_ok, hex(data) AS data FROM sub_s",
    "envelope_parse": f"WITH {SUBMISSIONS} SELECT event_id, epoch, chain FROM sub_s",
    "channel_route": f"WITH {SUBMISSIONS} SELECT event_id, channel, known FROM sub_s",
    "min_revision": f"""WITH {SUBMISSIONS}
SELECT event_id, channel, coalesce(is_old, FALSE) AS ignored FROM sub_s WHERE known""",
    "threshold_range": f"""WITH {SUBMISSIONS}
SELECT event_id, CAST(thr AS BIGINT) AS request_threshold, bad_thr AS rejected FROM sub_s""",
    "intake_status": f"""WITH {SUBMISSIONS}
SELECT event_id, channel, status, accepted, CASE WHEN accepted THEN epoch END AS epoch FROM sub_s""",
    "accepted_records": f"""WITH {SUBMISSIONS}
SELECT channel, epoch, chain, CAST(coalesce(thr, 50) AS BIGINT) AS threshold, count(*) AS n FROM sub_s WHERE accepted GROUP BY ALL""",
    "read_records": f"""WITH {_RECORDS}
SELECT partition, "offset", CAST(epoch AS INTEGER) AS epoch, {sql.joined('layers')} AS chain, threshold
FROM recs WHERE "offset" >= 100 * partition""",
    "header_threshold": f'WITH {_RECORDS} SELECT partition, "offset", threshold FROM recs',
    "bounded_batch": f"""WITH {_RECORDS}
SELECT partition, count(*) AS records, CAST(1 AS BIGINT) AS times, max("offset") AS last_offset FROM recs
WHERE (partition <> 0 OR "offset" >= 50) AND (partition <> 1 OR "offset" // 64 % 2 = 1)
  AND (partition <> 2 OR "offset" % 5 = 0) GROUP BY partition""",
    "arrival_rate": f"""WITH c AS (SELECT epoch_us(ts) // 3000000000 AS f, count(*) AS n FROM events GROUP BY ALL),
g AS (SELECT unnest(range((SELECT min(f) FROM c), (SELECT max(f) FROM c) + 1)) AS f)
SELECT strftime(make_timestamp(g.f * 3000000000), '%Y-%m-%d %H:%M:%S') AS start, coalesce(n, 0) AS messages,
       coalesce(n, 0) // 5 < 2 AS low
FROM g LEFT JOIN c ON g.f = c.f""",
    "csv_layers": """SELECT 'brand|' || trim(p_brand) || ',type|' || trim(p_type) || ',size|' ||
       CASE WHEN p_size % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS chain, count(*) AS n FROM part GROUP BY ALL""",
    "synth_messages": """SELECT CAST(1 AS SMALLINT) AS epoch, array_to_string(list_transform(range(7), lambda i:
    'layer' || CAST(i AS VARCHAR) || '|' ||
    CAST(CAST('0x' || substr(sha256(CAST(c_custkey AS VARCHAR) || '/' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT) AS VARCHAR)), ',') AS chain,
  CAST(50 AS BIGINT) AS total, FALSE AS is_partial FROM customer""",
    "message_file": f"""WITH {_RECORDS}
SELECT CAST(epoch AS INTEGER) AS epoch, {sql.joined('layers')} AS chain, count(*) AS n FROM recs GROUP BY ALL""",
    "split_measurement": """WITH t AS (
  SELECT event_id, CASE event_id % 5 WHEN 1 THEN 'type|' || event_type || '|x' WHEN 2 THEN 'type' || event_type
                        WHEN 4 THEN '|' || props ELSE 'type|' || event_type END AS txt FROM events)
SELECT event_id, CASE WHEN len(string_split(txt, '|')) = 2 THEN string_split(txt, '|')[1] END AS name,
       CASE WHEN len(string_split(txt, '|')) = 2 THEN string_split(txt, '|')[2] END AS "value" FROM t""",
    "bounds_check": """SELECT doc_id, length(source || '/' || lang) <= 64 AND length(text) <= 128
       AND n_chars * 10 BETWEEN 0 AND 32767 AS fits FROM documents""",
}

ORACLES["stream_intake"] = ORACLES["accepted_records"]
