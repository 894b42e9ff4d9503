"""Threshold aggregation over clear messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilcount.catalog import sql
from veilcount.operators import threshold as th
from veilcount.plans import datasets as ds


def _chain() -> F.Column:
    return F.array_join("prefix", ",").alias("chain")


def _revealed(messages: DataFrame) -> DataFrame:
    return th.reveal(messages).select(
        "epoch", F.size("prefix").cast("int").alias("depth"), _chain(), "total", "is_partial"
    )


def k_threshold(spark, sf):
    return _revealed(ds.lineitem_messages(spark, sf))


def k_threshold_events(spark, sf):
    return _revealed(ds.event_messages(spark, sf))


def k_threshold_orders(spark, sf):
    return _revealed(ds.order_messages(spark, sf))


def k_threshold_sets(spark, sf):
    """The threshold aggregation of events, with its classes counted by grouping sets."""
    messages = ds.event_messages(spark, sf)
    revealed = th.reveal(messages, th.class_counts_by_sets(messages))
    return revealed.select("epoch", F.size("prefix").alias("depth"), _chain(), "total", "is_partial")


def _revealed_sql(messages: str, source: str) -> str:
    return f"""WITH {messages},{sql.revealed(source)}
SELECT epoch, CAST(len(prefix) AS INTEGER) AS depth, {sql.joined('prefix')} AS chain, total, is_partial FROM revealed"""


def group_counts(spark, sf):
    """Messages by epoch, outer tag and threshold."""
    first = ds.lineitem_messages(spark, sf).withColumn("prefix", F.slice("layers", 1, 1))
    return first.groupBy("epoch", _chain(), "threshold").agg(F.count(F.lit(1)).alias("n"))


def eligible_tags(spark, sf):
    """Order months as batches: batch 2 arrives while batches 0 and 1 are pending."""
    messages = ds.lineitem_messages(spark, sf).withColumn("tag", F.array_join("layers", ","))
    counts = messages.groupBy("epoch", "tag", "threshold", (F.col("batch") == 2).alias("is_new")).agg(
        F.count(F.lit(1)).alias("n")
    )
    eligible = th.eligible_classes(
        counts.filter("is_new").drop("is_new"), counts.filter("NOT is_new").drop("is_new"), ["epoch", "tag"]
    )
    return eligible.groupBy("epoch", "tag").agg(F.min("threshold").alias("recovery_threshold"))


def prefix_explode(spark, sf):
    rows = th.prefixes(th.collapse(ds.event_messages(spark, sf)))
    return rows.groupBy("epoch", _chain(), "threshold").agg(F.sum("n").alias("n"))


def layer_rounds(spark, sf):
    return th.rounds(ds.lineitem_messages(spark, sf)).withColumn("round", F.col("round").cast("int"))


def recovered_counts(spark, sf):
    """Messages of each recovered prefix, and the smallest threshold that recovered it."""
    nodes = th.recovered_nodes(ds.lineitem_messages(spark, sf))
    return nodes.select("epoch", _chain(), F.col("n").alias("count"), F.col("recovery_threshold").cast("int"))


def has_children(spark, sf):
    nodes = th.recovered_nodes(ds.order_messages(spark, sf))
    return nodes.select("epoch", _chain(), "has_children")


def run_totals(spark, sf):
    """Sums of the reported totals, of the messages that stay hidden and of those with malformed layers, by epoch.

    The malformed ones are part of what is reported or hidden: they count down to their last good layer.
    """
    messages = ds.with_defective_layers(ds.event_messages(spark, sf), F.col("event_id"))
    rows = th.collapse(messages)
    reported = th.reveal(rows).select(
        "epoch",
        F.when(~F.col("is_partial"), F.col("total")).alias("full"),
        F.when(F.col("is_partial"), F.col("total")).alias("partial"),
    )
    errors = F.when(th.well_formed(F.col("layers")) < F.size("layers"), F.col("n"))
    received = rows.select("epoch", F.col("n").alias("received"), errors.alias("malformed"))
    both = received.unionByName(reported, allowMissingColumns=True)
    total = lambda name: F.coalesce(F.sum(name), F.lit(0).cast("bigint"))
    summed = both.groupBy("epoch").agg(
        total("received").alias("received"),
        total("malformed").alias("malformed"),
        total("full").alias("full_total"),
        total("partial").alias("partial_total"),
    )
    return summed.withColumn("unrevealed", F.col("received") - F.col("full_total") - F.col("partial_total"))


def distinct_epochs(spark, sf):
    return th.recovered_nodes(ds.event_messages(spark, sf)).select("epoch").distinct()


def union_pending(spark, sf):
    """New and pending messages of a class together, before recovery."""
    messages = ds.event_messages(spark, sf).withColumn("prefix", F.slice("layers", 1, 2))
    new = messages.filter(F.col("event_id") % 2 == 0).select("epoch", _chain(), "threshold", F.lit(True).alias("new"))
    pending = messages.filter(F.col("event_id") % 2 == 1).select(
        "epoch", _chain(), "threshold", F.lit(False).alias("new")
    )
    return new.unionByName(pending).groupBy("epoch", "chain", "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("new").alias("n_new")
    )


def class_set(spark, sf):
    messages = ds.event_messages(spark, sf).withColumn("tag", F.array_join("layers", ","))
    sets = th.thresholds_present(messages, ["epoch", "tag"])
    return sets.select("epoch", "tag", F.array_join(F.col("thresholds").cast("array<string>"), ",").alias("thresholds"))


QUERIES = {
    "k_threshold": k_threshold,
    "k_threshold_events": k_threshold_events,
    "k_threshold_orders": k_threshold_orders,
    "k_threshold_sets": k_threshold_sets,
    "group_counts": group_counts,
    "eligible_tags": eligible_tags,
    "prefix_explode": prefix_explode,
    "layer_rounds": layer_rounds,
    "recovered_counts": recovered_counts,
    "has_children": has_children,
    "run_totals": run_totals,
    "distinct_epochs": distinct_epochs,
    "union_pending": union_pending,
    "class_set": class_set,
}

ORACLES = {
    "k_threshold": _revealed_sql(sql.LINEITEM_MSGS, "line_msgs"),
    "k_threshold_events": _revealed_sql(sql.EVENT_MSGS, "event_msgs"),
    "k_threshold_orders": _revealed_sql(sql.ORDER_MSGS, "order_msgs"),
    "k_threshold_sets": _revealed_sql(sql.EVENT_MSGS, "event_msgs"),
    "group_counts": f"""WITH {sql.LINEITEM_MSGS}
SELECT epoch, layers[1] AS chain, threshold, count(*) AS n FROM line_msgs GROUP BY ALL""",
    "eligible_tags": f"""WITH {sql.LINEITEM_MSGS},
c AS (SELECT epoch, {sql.joined('layers')} AS tag, threshold, count(*) AS n, count(*) FILTER (batch = 2) AS n_new
      FROM line_msgs GROUP BY ALL)
SELECT epoch, tag, min(threshold) AS recovery_threshold FROM c WHERE n_new > 0 AND n >= threshold AND threshold >= 2 GROUP BY ALL""",
    "prefix_explode": f"""WITH {sql.EVENT_MSGS},{sql.classes('event_msgs')}
SELECT epoch, {sql.joined('prefix')} AS chain, threshold, n FROM classes""",
    "layer_rounds": f"""WITH {sql.LINEITEM_MSGS},{sql.classes('line_msgs')},{sql.nodes()},
m AS (SELECT epoch, layers, unnest(range(1, len(layers) + 1)) AS round FROM line_msgs)
SELECT m.epoch, CAST(round AS INTEGER) AS round, count(DISTINCT prefix) AS tags_opened, count(*) AS messages_opened,
       count(*) FILTER (round < len(layers)) AS messages_passed_on
FROM m JOIN nodes ON m.epoch = nodes.epoch AND m.layers[1:round] = nodes.prefix GROUP BY ALL""",
    "recovered_counts": f"""WITH {sql.LINEITEM_MSGS},{sql.classes('line_msgs')},{sql.nodes()}
SELECT epoch, {sql.joined('prefix')} AS chain, CAST(n AS BIGINT) AS "count", recovery_threshold FROM nodes""",
    "has_children": f"""WITH {sql.ORDER_MSGS},{sql.classes('order_msgs')},{sql.nodes()}
SELECT epoch, {sql.joined('prefix')} AS chain, has_children FROM nodes""",
    "run_totals": f"""WITH {sql.EVENT_MSGS},
typed AS (SELECT epoch, {sql.DEFECTS} AS layers, threshold FROM event_msgs),{sql.cut('typed')},{sql.revealed('cut')},
r AS (SELECT epoch, sum(total) FILTER (NOT is_partial) AS f, sum(total) FILTER (is_partial) AS p FROM revealed GROUP BY epoch),
a AS (SELECT epoch, count(*) AS received, count(*) FILTER (bad > 0) AS malformed FROM marked GROUP BY epoch)
SELECT a.epoch, received, malformed, CAST(coalesce(f, 0) AS BIGINT) AS full_total, CAST(coalesce(p, 0) AS BIGINT) AS partial_total,
       CAST(received - coalesce(f, 0) - coalesce(p, 0) AS BIGINT) AS unrevealed
FROM a LEFT JOIN r ON a.epoch = r.epoch""",
    "distinct_epochs": f"""WITH {sql.EVENT_MSGS},{sql.classes('event_msgs')},{sql.nodes()}
SELECT DISTINCT epoch FROM nodes""",
    "union_pending": f"""WITH {sql.EVENT_MSGS}
SELECT epoch, {sql.joined('layers[1:2]')} AS chain, threshold, count(*) AS n, count(*) FILTER (event_id % 2 = 0) AS n_new
FROM event_msgs GROUP BY ALL""",
    "class_set": f"""WITH {sql.EVENT_MSGS}
SELECT epoch, {sql.joined('layers')} AS tag, string_agg(DISTINCT CAST(threshold AS VARCHAR), ',' ORDER BY CAST(threshold AS VARCHAR)) AS thresholds
FROM event_msgs GROUP BY ALL""",
}
