"""State tables, look-ups, and runs over several batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from veilcount.catalog import sql
from veilcount.catalog.report import chain_text, recovered_rows
from veilcount.functions.epochs import EpochClock
from veilcount.functions.tags import prefix_tag, tag_path
from veilcount.operators import incremental, skew, state, threshold as th
from veilcount.plans import datasets as ds
from veilcount.plans.job import Aggregation, Settings
from veilcount.session import new_work_folder
from veilcount.streaming.batches import start_run

# A clock that lies after all lineitem epochs, so that each of them is expired.
LATER = EpochClock(200, datetime(2020, 1, 1), ds.LINEITEM_EPOCH, 3)
LATER_NOW = "2019-12-31 00:00:00"


def _aggregation(spark, clock=LATER, now=LATER_NOW, **settings) -> Aggregation:
    folder = new_work_folder(spark, "aggregation")
    return Aggregation(spark, Settings(clock, folder, **settings), F.lit(now).cast("timestamp"))


def _batch(messages, *numbers):
    return messages.filter(F.col("batch").isin(*numbers)).drop("batch")


def _tagged(messages, depth=None):
    """Messages with the tag of their whole chain, or of its first layers."""
    prefix = F.col("layers") if depth is None else F.slice("layers", 1, depth)
    return messages.withColumn("tag", prefix_tag(F.col("epoch"), prefix))


def _collapsed(spark, sf):
    """Equal messages of a part as one row, so that a chain is hashed once per part and not per message."""
    messages = ds.lineitem_messages(spark, sf)
    return messages.groupBy("epoch", "layers", "threshold", "batch").agg(F.count(F.lit(1)).alias("n"))


def lookup_recovered(spark, sf):
    """Rows recovered from batches 0 and 1 for the outer two-layer tags of batch 2."""
    messages = _collapsed(spark, sf)
    recovered = recovered_rows(messages.filter("batch < 2"))
    found = state.lookup_recovered(_tagged(messages.filter("batch = 2"), 2), recovered)
    return found.select("epoch", chain_text(), "count")


def lookup_by_ranges(spark, sf):
    """The same look-up in written state, of whose files only the pages around the asked tags are read."""
    tables = state.StateTables(spark, new_work_folder(spark, "state"), incremental.PENDING)
    nodes = th.prefix_nodes(th.class_counts(_batch(ds.lineitem_messages(spark, sf), 0, 1)))
    tables.write("recovered", 0, incremental.as_changes(nodes))
    tables.write_nothing("pending", 0)
    tables.commit(0)
    tags = _tagged(_collapsed(spark, sf).filter("batch = 2"), 2)
    near = tables.read("recovered").filter(state.in_ranges(state.tag_ranges(tags)))
    return state.current_recovered(state.lookup_recovered(tags, near)).select("epoch", chain_text(), "count")


def stream_batches(spark, sf):
    """A whole run of the records as a stream that arrives in three parts and is started anew for each."""
    rows, source, checkpoint = ds.records(spark, sf), new_work_folder(spark, "topic"), new_work_folder(spark, "progress")
    clock, now = _EVENT_CLOCK
    job = _aggregation(spark, clock, now)
    third = -(-rows.count() // 12)  # a third of the offsets of each of the four partitions
    for number in range(3):
        part = rows.filter(F.least(F.floor(F.col("offset") / third), F.lit(2)) == number)
        part.write.mode("append").parquet(source)
        start_run(job, spark.readStream.schema(rows.schema).parquet(source), checkpoint).awaitTermination()
    job.expire()
    return _totals(job.measurements(), _EVENT_NAMES).drop("is_partial")


def lookup_pending(spark, sf):
    """Pending messages of batches 0 and 1 for those tags of batch 2 that are not recovered."""
    messages = _tagged(_collapsed(spark, sf))
    earlier = messages.filter("batch < 2")
    found = state.lookup_pending(messages.filter("batch = 2"), recovered_rows(earlier), earlier)
    return found.groupBy("epoch", F.array_join("layers", ",").alias("chain"), "threshold").agg(
        F.sum("n").alias("n")
    )


def join_keys(spark, sf):
    """Messages of every class of a recovered tag of any depth, joined to the tag's row."""
    messages = ds.event_messages(spark, sf)
    folder = new_work_folder(spark, "keys")
    keyed = recovered_rows(messages).select("epoch", "tag", F.col("count").alias("n"), "chain")
    keyed.write.parquet(folder)
    tags = F.explode(tag_path(F.col("epoch"), F.col("layers"))).alias("tag")
    rows = messages.select("epoch", tags, "threshold", "msg_id")
    opened = skew.spread_join(rows, spark.read.parquet(folder), ["epoch", "tag"], skew.heavy_rows(rows.count()), "msg_id")
    return opened.groupBy("epoch", chain_text(), "threshold").agg(F.count(F.lit(1)).alias("n"))


def children(spark, sf):
    rows = state.children(recovered_rows(ds.event_messages(spark, sf)))
    return rows.select("epoch", F.hex("parent_tag").alias("parent_tag"), F.hex("tag").alias("tag"))


def pending_delete(spark, sf):
    """What stays pending of batches 0 and 1 once the whole-chain tags recovered over all batches are opened."""
    messages = _tagged(_collapsed(spark, sf))
    left = state.live_pending(messages.filter("batch < 2"), recovered_rows(messages.drop("tag")))
    return left.groupBy("epoch", F.array_join("layers", ",").alias("chain"), "threshold").agg(
        F.sum("n").alias("n")
    )


def upsert_recovered(spark, sf):
    """Counts of three batches, written one after another and read as one current row per tag."""
    tables = state.StateTables(spark, new_work_folder(spark, "state"), incremental.PENDING)
    messages = ds.lineitem_messages(spark, sf)
    for number in range(3):
        nodes = th.prefix_nodes(th.class_counts(_batch(messages, number)))
        tables.write("recovered", number, incremental.as_changes(nodes))
        tables.write_nothing("pending", number)
        tables.commit(number)
    return tables.recovered().select("epoch", chain_text(), "count", "has_children")


def _run(spark, sf, *batches):
    """A job that has run batches of messages, each made of some of the three parts."""
    messages = ds.lineitem_messages(spark, sf)
    job = _aggregation(spark)
    for numbers in batches:
        part = _batch(messages, *numbers)
        job.run_batch(part, part.count())
    return job


def store_pending(spark, sf):
    """Pending rows after two batches: each message waits at its first prefix that is not recovered."""
    tables = _run(spark, sf, (0,), (1, 2)).tables
    live = state.live_pending(tables.read("pending").drop("batch"), tables.recovered())
    stuck = F.array_join(F.expr("slice(layers, 1, depth)"), ",").alias("chain")
    return live.groupBy("epoch", stuck, "threshold").agg(F.sum("n").alias("n"))


def purge_epoch(spark, sf):
    """Rows of both tables when epochs 0 and 1 are purged after a first batch; a second fills them from nothing."""
    job = _run(spark, sf, (0,))
    job.tables.purge([0, 1])
    part = _batch(ds.lineitem_messages(spark, sf), 1, 2)
    job.run_batch(part, part.count())
    recovered, pending = job.tables.recovered(), job.tables.read("pending")
    held = state.live_pending(pending, recovered).groupBy("epoch").agg(F.sum("n").alias("pending"))
    known = recovered.groupBy("epoch").agg(F.count(F.lit(1)).alias("tags"))
    both = known.join(held, "epoch", "full")
    return both.select(
        "epoch",
        F.coalesce("tags", F.lit(0)).cast("bigint").alias("tags"),
        F.coalesce("pending", F.lit(0)).cast("bigint").alias("pending"),
    )


def deleted_files(spark, sf):
    """Rows that files still hold after a purge of epochs 0 and 1, a vacuum, a second batch, a compaction and a vacuum.

    stage 0 is the state after the first vacuum, stage 1 that after the second. Every file counts, whether it is read or not.
    """
    job = _run(spark, sf, (0,))
    job.tables.purge([0, 1])
    job.tables.vacuum()
    folder = new_work_folder(spark, "stored")

    def keep(stage):
        tags = job.tables.stored("recovered").groupBy("epoch").agg(F.count_distinct("tag").alias("tags"))
        held = job.tables.stored("pending").groupBy("epoch").agg(F.sum("n").alias("pending"))
        columns = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("tags", "pending")]
        rows = tags.join(held, "epoch", "full").select(F.lit(stage).alias("stage"), "epoch", *columns)
        rows.write.mode("append").parquet(folder)

    keep(0)
    part = _batch(ds.lineitem_messages(spark, sf), 1, 2)
    job.run_batch(part, part.count())
    job.tables.compact()
    job.tables.vacuum()
    keep(1)
    return spark.read.parquet(folder)


def _totals(measurements, names):
    cell = lambda n: F.concat(F.lit(f"{n}|"), F.get_json_object("json", f"$.{n}"))
    rows = measurements.select(
        "epoch", F.concat_ws(",", *[cell(n) for n in names]).alias("chain"), "is_partial", "total"
    )
    summed = rows.groupBy("epoch", "chain", "is_partial").agg(F.sum("total").alias("total"))
    return summed.filter("total > 0")


_LINE_NAMES = ("flag", "status", "disc", "qty")
_EVENT_NAMES = ("type", "hour", "uid", "k")


class _Interrupted(Exception):
    pass


def replay_idempotent(spark, sf):
    """A batch that dies before its commit is run again; the result is that of running it once."""
    messages = ds.lineitem_messages(spark, sf)
    job = _run(spark, sf, (0,))
    part = _batch(messages, 1, 2)
    commit = job.tables.commit

    def die(*_, **__):
        raise _Interrupted

    job.tables.commit = die
    try:
        job.run_batch(part, part.count())
    except _Interrupted:
        pass
    job.tables.commit = commit
    job.run_batch(part, part.count())
    job.expire()
    return _totals(job.measurements(), _LINE_NAMES)


def incremental_equals_batch(spark, sf):
    """Three batches and the expiry report add up to the threshold aggregation of all messages."""
    job = _run(spark, sf, (0,), (1,), (2,))
    job.expire()
    return _totals(job.measurements(), _LINE_NAMES)


_EVENT_CLOCK = EpochClock(4, datetime(2024, 2, 5), ds.EVENT_EPOCH, 3), "2024-01-30 12:00:00"


def event_job(spark, records, batches=3, **settings):
    """A whole run over records in so many bounded batches or one more, then expiry."""
    clock, now = _EVENT_CLOCK
    limit = -(-records.count() // batches)
    job = _aggregation(spark, clock, now, max_messages=limit, iterations=100, min_messages=1, **settings)
    job.run_all(records)
    return job


def measurement_sink(spark, sf):
    """Records through a whole run of bounded batches; only measurements of committed batches are read."""
    job = event_job(spark, ds.records(spark, sf), compact_every=2)
    return _totals(job.measurements(), _EVENT_NAMES).drop("is_partial")


def job_totals(spark, sf):
    """What a whole run reported, from the sums that its writes observed and its commit rows hold."""
    commits = event_job(spark, ds.records(spark, sf)).tables.commits()
    of_expiry = F.size("purged") > 0
    return commits.agg(
        F.sum(F.when(~of_expiry, F.col("reported")).otherwise(0)).alias("full_total"),
        F.sum(F.when(of_expiry, F.col("reported")).otherwise(0)).alias("partial_total"),
    )


def malformed_layers(spark, sf):
    """Records with defective layers through a whole run: what is revealed by epoch and chain, what is lost by epoch."""
    records = ds.with_defects(ds.records(spark, sf))
    job = event_job(spark, records, batches=1, max_failed=2**31, max_failed_top=2**31)
    shown = _totals(job.measurements(), _EVENT_NAMES).select("epoch", "chain", "total", F.lit(False).alias("lost"))
    lost = job.quarantine().groupBy("epoch").agg(F.sum("n").alias("total"))
    return shown.unionByName(lost.select("epoch", F.lit("").alias("chain"), "total", F.lit(True).alias("lost")))


def malformed_at_once(spark, sf):
    """Defective layers in one aggregation over all messages: they and all below them stay with the layer above."""
    revealed = th.reveal(ds.with_defective_layers(ds.event_messages(spark, sf), F.col("event_id")))
    return revealed.select("epoch", F.array_join("prefix", ",").alias("chain"), "total", "is_partial")


def mixed_classes(spark, sf):
    """Classes with thresholds 0 and 1 beside others: they open nothing, and count once another class opens the tag."""
    number = F.col("event_id")
    threshold = F.when(number % 4 == 0, 0).when(number % 4 == 1, 1).otherwise(F.col("threshold"))
    revealed = th.reveal(ds.event_messages(spark, sf).withColumn("threshold", threshold))
    return revealed.select("epoch", F.array_join("prefix", ",").alias("chain"), "total", "is_partial")


def many_batches(spark, sf):
    """Six batches with compactions in between add up to the threshold aggregation of all messages."""
    messages = ds.event_messages(spark, sf).withColumn("part", (F.col("event_id") % 6).cast("int"))
    folder = new_work_folder(spark, "parts")
    messages.select("epoch", "layers", "threshold", "part").write.partitionBy("part").parquet(folder)
    clock, now = _EVENT_CLOCK
    job = _aggregation(spark, clock, now, compact_every=3)
    stored = spark.read.parquet(folder)
    for number in range(6):
        part = stored.filter(F.col("part") == number).drop("part")
        job.run_batch(part, part.count())
    job.expire()
    return _totals(job.measurements(), _EVENT_NAMES).drop("is_partial")


QUERIES = {
    "lookup_recovered": lookup_recovered,
    "lookup_by_ranges": lookup_by_ranges,
    "stream_batches": stream_batches,
    "lookup_pending": lookup_pending,
    "join_keys": join_keys,
    "children": children,
    "pending_delete": pending_delete,
    "upsert_recovered": upsert_recovered,
    "store_pending": store_pending,
    "purge_epoch": purge_epoch,
    "deleted_files": deleted_files,
    "replay_idempotent": replay_idempotent,
    "incremental_equals_batch": incremental_equals_batch,
    "measurement_sink": measurement_sink,
    "job_totals": job_totals,
    "malformed_layers": malformed_layers,
    "malformed_at_once": malformed_at_once,
    "mixed_classes": mixed_classes,
    "many_batches": many_batches,
}


def _stuck(source: str, name: str) -> str:
    """Messages at their first prefix that is not recovered."""
    return f"""{sql.classes(source, name + '_c')},{sql.nodes(name + '_c', name + '_n')},
{name}_m AS (SELECT row_number() OVER () AS id, epoch, layers, threshold FROM {source}),
{name}_d AS (
  SELECT m.id, count(n.prefix) AS depth
  FROM (SELECT *, unnest(range(1, len(layers) + 1)) AS d FROM {name}_m) m
  LEFT JOIN {name}_n n ON m.epoch = n.epoch AND m.layers[1:m.d] = n.prefix GROUP BY m.id),
{name} AS (
  SELECT epoch, layers[1:depth + 1] AS prefix, threshold, count(*) AS n
  FROM {name}_m JOIN {name}_d USING (id) WHERE depth < len(layers) GROUP BY ALL)"""


_TOTALS = f"""SELECT epoch, {sql.joined('prefix')} AS chain, is_partial, total FROM revealed"""

ORACLES = {
    "lookup_recovered": f"""WITH {sql.LINEITEM_MSGS},
a AS (SELECT * FROM line_msgs WHERE batch < 2),{sql.classes('a')},{sql.nodes()}
SELECT epoch, {sql.joined('prefix')} AS chain, CAST(n AS BIGINT) AS "count" FROM nodes WHERE EXISTS (
  SELECT 1 FROM line_msgs m WHERE batch = 2 AND m.epoch = nodes.epoch AND m.layers[1:2] = nodes.prefix)""",
    "lookup_pending": f"""WITH {sql.LINEITEM_MSGS},
a AS (SELECT * FROM line_msgs WHERE batch < 2),{sql.classes('a')},{sql.nodes()}
SELECT epoch, {sql.joined('layers')} AS chain, threshold, count(*) AS n FROM a
WHERE EXISTS (SELECT 1 FROM line_msgs m WHERE batch = 2 AND m.epoch = a.epoch AND m.layers = a.layers)
  AND NOT EXISTS (SELECT 1 FROM nodes WHERE nodes.epoch = a.epoch AND nodes.prefix = a.layers) GROUP BY ALL""",
    "join_keys": f"""WITH {sql.EVENT_MSGS},{sql.classes('event_msgs')},{sql.nodes()}
SELECT c.epoch, {sql.joined('c.prefix')} AS chain, c.threshold, c.n FROM classes c JOIN nodes
ON c.epoch = nodes.epoch AND c.prefix = nodes.prefix""",
    "children": f"""WITH {sql.EVENT_MSGS},{sql.classes('event_msgs')},{sql.nodes()}
SELECT epoch, CASE WHEN len(prefix) > 1 THEN {sql.tag_hex('epoch', 'prefix[1:len(prefix) - 1]')} END AS parent_tag,
       {sql.tag_hex('epoch', 'prefix')} AS tag FROM nodes""",
    "pending_delete": f"""WITH {sql.LINEITEM_MSGS},{sql.classes('line_msgs')},{sql.nodes()}
SELECT epoch, {sql.joined('layers')} AS chain, threshold, count(*) AS n FROM line_msgs m
WHERE batch < 2 AND NOT EXISTS (SELECT 1 FROM nodes WHERE nodes.epoch = m.epoch AND nodes.prefix = m.layers) GROUP BY ALL""",
    "upsert_recovered": f"""WITH {sql.LINEITEM_MSGS},{sql.classes('line_msgs')}
SELECT epoch, {sql.joined('prefix')} AS chain, CAST(sum(n) AS BIGINT) AS "count", bool_or(goes_on) AS has_children
FROM classes GROUP BY epoch, prefix""",
    "store_pending": f"""WITH {sql.LINEITEM_MSGS},
{_stuck('line_msgs', 's').lstrip()}
SELECT epoch, {sql.joined('prefix')} AS chain, threshold, n FROM s""",
    "purge_epoch": f"""WITH {sql.LINEITEM_MSGS},
a AS (SELECT * FROM line_msgs WHERE batch > 0 OR epoch > 1),{_stuck('a', 's')},
n AS (SELECT epoch, count(*) AS tags FROM s_n GROUP BY epoch),
p AS (SELECT epoch, sum(n) AS pending FROM s GROUP BY epoch)
SELECT coalesce(n.epoch, p.epoch) AS epoch, coalesce(tags, 0) AS tags, CAST(coalesce(pending, 0) AS BIGINT) AS pending
FROM n FULL JOIN p ON n.epoch = p.epoch""",
    "deleted_files": f"""WITH {sql.LINEITEM_MSGS},
a AS (SELECT * FROM line_msgs WHERE batch = 0 AND epoch > 1),{_stuck('a', 's')},
b AS (SELECT * FROM line_msgs WHERE batch > 0 OR epoch > 1),{_stuck('b', 't')},
n AS (SELECT 0 AS stage, epoch, count(*) AS tags FROM s_n GROUP BY epoch UNION ALL SELECT 1, epoch, count(*) FROM t_n GROUP BY epoch),
p AS (SELECT 0 AS stage, epoch, sum(n) AS pending FROM s GROUP BY epoch UNION ALL SELECT 1, epoch, sum(n) FROM t GROUP BY epoch)
SELECT stage, epoch, coalesce(tags, 0) AS tags, CAST(coalesce(pending, 0) AS BIGINT) AS pending FROM n FULL JOIN p USING (stage, epoch)""",
    "replay_idempotent": f"WITH {sql.LINEITEM_MSGS},{sql.revealed('line_msgs')} {_TOTALS}",
    "incremental_equals_batch": f"WITH {sql.LINEITEM_MSGS},{sql.revealed('line_msgs')} {_TOTALS}",
    "measurement_sink": f"""WITH {sql.EVENT_MSGS},
typed AS (
  SELECT epoch, layers, CASE event_id % 13 WHEN 0 THEN 50 WHEN 1 THEN 0 WHEN 2 THEN 50 WHEN 3 THEN 50 WHEN 4 THEN 306 ELSE 20 END AS threshold
  FROM event_msgs),{sql.revealed('typed')}
SELECT epoch, {sql.joined('prefix')} AS chain, total FROM revealed WHERE NOT is_partial OR 4 - epoch >= 3""",
    "job_totals": f"""WITH {sql.EVENT_MSGS},
typed AS (
  SELECT epoch, layers, CASE event_id % 13 WHEN 0 THEN 50 WHEN 1 THEN 0 WHEN 2 THEN 50 WHEN 3 THEN 50 WHEN 4 THEN 306 ELSE 20 END AS threshold
  FROM event_msgs),{sql.revealed('typed')}
SELECT CAST(coalesce(sum(total) FILTER (NOT is_partial), 0) AS BIGINT) AS full_total,
       CAST(coalesce(sum(total) FILTER (is_partial AND 4 - epoch >= 3), 0) AS BIGINT) AS partial_total FROM revealed""",
    "many_batches": f"""WITH {sql.EVENT_MSGS},{sql.revealed('event_msgs')}
SELECT epoch, {sql.joined('prefix')} AS chain, total FROM revealed WHERE NOT is_partial OR 4 - epoch >= 3""",
    "mixed_classes": f"""WITH {sql.EVENT_MSGS},
typed AS (
  SELECT epoch, layers, CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE threshold END AS threshold FROM event_msgs),{sql.revealed('typed')}
SELECT epoch, {sql.joined('prefix')} AS chain, total, is_partial FROM revealed""",
    "malformed_at_once": f"""WITH {sql.EVENT_MSGS},
typed AS (SELECT epoch, {sql.DEFECTS} AS layers, threshold FROM event_msgs),{sql.cut('typed')},{sql.revealed('cut')}
SELECT epoch, {sql.joined('prefix')} AS chain, total, is_partial FROM revealed""",
    "malformed_layers": f"""WITH {sql.EVENT_MSGS},
typed AS (
  SELECT epoch, {sql.DEFECTS} AS layers,
         CASE event_id % 13 WHEN 0 THEN 50 WHEN 1 THEN 0 WHEN 2 THEN 50 WHEN 3 THEN 50 WHEN 4 THEN 306 ELSE 20 END AS threshold,
         event_id % 4 AS partition, event_id // 4 AS "offset"
  FROM event_msgs),{sql.cut('typed')},{sql.revealed('cut')}
SELECT epoch, {sql.joined('prefix')} AS chain, total, FALSE AS lost FROM revealed WHERE NOT is_partial OR 4 - epoch >= 3
UNION ALL
SELECT epoch, '', CAST(sum(n) AS BIGINT), TRUE FROM (
  SELECT epoch, sum(n) AS n FROM (SELECT epoch, layers[1:bad] AS p, threshold, count(*) AS n FROM marked WHERE bad > 0 GROUP BY ALL)
  GROUP BY epoch, p HAVING bool_or(n >= threshold AND threshold >= 2)) GROUP BY epoch""",
}

ORACLES["lookup_by_ranges"] = ORACLES["lookup_recovered"]
ORACLES["stream_batches"] = ORACLES["measurement_sink"]
