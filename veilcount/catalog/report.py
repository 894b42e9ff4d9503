"""Reports over recovered rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from veilcount.catalog import sql
from veilcount.functions.epochs import EpochClock
from veilcount.functions.measurements import measurement_json as as_json
from veilcount.operators import report, state, threshold as th
from veilcount.operators.incremental import as_changes
from veilcount.plans import datasets as ds
from veilcount.session import new_work_folder

CLOCK = EpochClock(4, datetime(2024, 2, 5), ds.EVENT_EPOCH, 3)
NOW = "2024-01-30 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def recovered_rows(messages):
    """Recovered state as it stands after all messages and before any report."""
    return state.current_recovered(as_changes(th.recovered_nodes(messages)))


def stored_rows(spark, messages):
    """The same as a written table, which the reports read several times."""
    folder = new_work_folder(spark, "recovered")
    recovered_rows(messages).write.parquet(folder)
    return spark.read.parquet(folder)


def chain_text(column="chain"):
    return F.array_join(F.transform(column, lambda c: F.concat(c["name"], F.lit("|"), c["value"])), ",").alias("chain")


def report_full(spark, sf):
    return report.full_report(stored_rows(spark, ds.lineitem_messages(spark, sf))).select("epoch", chain_text(), "total")


def report_partial(spark, sf):
    rows = report.partial_report(stored_rows(spark, ds.lineitem_messages(spark, sf)))
    return rows.select("epoch", chain_text(), "total")


def residual_counts(spark, sf):
    recovered = stored_rows(spark, ds.lineitem_messages(spark, sf))
    return report.residual_counts(recovered, report.full_report(recovered)).select("epoch", chain_text(), "count")


def nonzero(spark, sf):
    """Rows that still hold messages after the full report, of all epochs that have any."""
    recovered = stored_rows(spark, ds.lineitem_messages(spark, sf))
    left = report.residual_counts(recovered, report.full_report(recovered))
    epochs = [row.epoch for row in left.select("epoch").distinct().collect()]  # at most 256
    return report.nonzero(left, epochs).select("epoch", chain_text(), "count")


def metric_chain(spark, sf):
    rows = recovered_rows(ds.event_messages(spark, sf))
    return rows.select(
        "epoch",
        F.hex("tag").alias("tag"),
        F.array_join("chain.name", ">").alias("names"),
        F.array_join("chain.value", ">").alias("values"),
    )


def chain_pointers(spark, sf):
    """The chains of ``metric_chain`` from tags and parents alone."""
    rows = stored_rows(spark, ds.event_messages(spark, sf)).select("epoch", "tag", "parent_tag", "name", "value")
    chains = report.chains_from_parents(rows, new_work_folder(spark, "chains"))
    return chains.select(
        "epoch",
        F.hex("tag").alias("tag"),
        F.array_join("chain.name", ">").alias("names"),
        F.array_join("chain.value", ">").alias("values"),
    )


def measurement_json(spark, sf):
    """Chains in which a name comes twice and two names clash with the reserved ones."""
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    chain = F.array(
        pair("segment", F.col("c_nationkey")),
        pair("total", F.lit("none")),
        pair("nation", F.col("c_nationkey")),
        pair("wos", F.lit("never")),
        pair("segment", F.col("c_mktsegment")),
    )
    json = as_json(chain, F.col("c_custkey") + 1, "wos", F.lit("2024-01-29"))
    field = lambda name: F.get_json_object("json", f"$.{name}").alias(name)
    return ds.table(spark, sf, "customer").select("c_custkey", json.alias("json")).select(
        "c_custkey",
        field("segment"),
        field("nation"),
        field("total"),
        field("wos"),
        F.size(F.json_object_keys("json")).alias("fields"),
        F.col("json").contains('"total":"').alias("total_is_text"),
    )


def expire_epochs(spark, sf):
    """Partial measurements of the expired epochs."""
    recovered = stored_rows(spark, ds.event_messages(spark, sf))
    emitted = report.partial_report(report.nonzero(report.expired_rows(recovered, CLOCK, now())))
    written = report.measurements(emitted, CLOCK, now())
    field = lambda name: F.get_json_object("json", f"$.{name}").alias(name)
    return written.select("epoch", field("type"), field("hour"), field("uid"), field("k"), field("wos"), "total")


QUERIES = {
    "report_full": report_full,
    "report_partial": report_partial,
    "residual_counts": residual_counts,
    "nonzero": nonzero,
    "metric_chain": metric_chain,
    "chain_pointers": chain_pointers,
    "measurement_json": measurement_json,
    "expire_epochs": expire_epochs,
}

_LINE_NODES = f"WITH {sql.LINEITEM_MSGS},{sql.classes('line_msgs')},{sql.nodes()}"
_LEFT = f"""{_LINE_NODES},
leaves AS (SELECT * FROM nodes WHERE NOT has_children),
taken AS (
  SELECT a.epoch, a.prefix, sum(l.n) AS t FROM nodes a JOIN leaves l
  ON a.epoch = l.epoch AND l.prefix[1:len(a.prefix)] = a.prefix GROUP BY ALL),
left_over AS (
  SELECT nodes.epoch, nodes.prefix, CAST(n - coalesce(t, 0) AS BIGINT) AS "count" FROM nodes LEFT JOIN taken
  ON nodes.epoch = taken.epoch AND nodes.prefix = taken.prefix)"""

ORACLES = {
    "report_full": f"""{_LINE_NODES}
SELECT epoch, {sql.joined('prefix')} AS chain, CAST(n AS BIGINT) AS total FROM nodes WHERE NOT has_children""",
    "report_partial": f"""WITH {sql.LINEITEM_MSGS},{sql.revealed('line_msgs')}
SELECT epoch, {sql.joined('prefix')} AS chain, total FROM revealed""",
    "residual_counts": f"""{_LEFT} SELECT epoch, {sql.joined('prefix')} AS chain, "count" FROM left_over""",
    "nonzero": f"""{_LEFT} SELECT epoch, {sql.joined('prefix')} AS chain, "count" FROM left_over WHERE "count" > 0""",
    "metric_chain": f"""WITH {sql.EVENT_MSGS},{sql.classes('event_msgs')},{sql.nodes()}
SELECT epoch, {sql.tag_hex('epoch', 'prefix')} AS tag,
       array_to_string(list_transform(prefix, lambda p: split_part(p, '|', 1)), '>') AS names,
       array_to_string(list_transform(prefix, lambda p: split_part(p, '|', 2)), '>') AS "values" FROM nodes""",
    "measurement_json": """SELECT c_custkey, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
       CAST(c_custkey + 1 AS VARCHAR) AS total, '2024-01-29' AS wos, 4 AS fields, FALSE AS total_is_text FROM customer""",
    "expire_epochs": f"""WITH {sql.EVENT_MSGS},{sql.revealed('event_msgs')}
SELECT epoch, split_part(prefix[1], '|', 2) AS type, CASE WHEN len(prefix) > 1 THEN split_part(prefix[2], '|', 2) END AS hour,
       CASE WHEN len(prefix) > 2 THEN split_part(prefix[3], '|', 2) END AS uid,
       CASE WHEN len(prefix) > 3 THEN split_part(prefix[4], '|', 2) END AS k,
       strftime(DATE '2024-01-01' + CAST(epoch AS INTEGER) * 7, '%Y-%m-%d') AS wos, total
FROM revealed WHERE 4 - epoch >= 3""",
}
ORACLES["chain_pointers"] = ORACLES["metric_chain"]
