"""One batch of clear messages on top of earlier state.

New messages and the pending messages of the tags they touch are counted together, layer by layer in one pass: a
pending message counts from the depth at which it is stuck. The result is the change to the state; summed over all
batches it equals the threshold aggregation of all messages at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilcount.functions.tags import prefix_tag, tag_path
from veilcount.functions.text import split_measurement
from veilcount.operators import state
from veilcount.operators.skew import heavy_rows, spread_join
from veilcount.operators.state import MAX_FAILED, MAX_FAILED_TOP
from veilcount.operators.threshold import collapse, reached, well_formed

PENDING = "epoch SMALLINT, tag BINARY, threshold INT, layers ARRAY<STRING>, depth INT, n BIGINT"


def _by_prefix(rows: DataFrame) -> DataFrame:
    """One row per collapsed row and depth from its first unopened one on, down to its first malformed layer.

    ``bad`` marks that layer: once its tag opens, its messages turn out to be broken.
    """
    good = well_formed(F.col("layers"))
    return (
        rows.withColumn("good", good)
        .withColumn("last", F.least(F.col("good") + 1, F.size("layers")))
        .filter(F.col("last") >= F.col("depth"))
        .withColumn("d", F.explode(F.sequence("depth", "last")))
        .withColumn("bad", F.col("d") > F.col("good"))
        .withColumn("prefix", F.expr("slice(layers, 1, d)"))
        .drop("good", "last")
    )


def _touched(rows: DataFrame) -> DataFrame:
    """The tags of all prefixes of the rows."""
    return rows.select("epoch", F.explode(tag_path(F.col("epoch"), F.col("layers"))).alias("tag"))


def as_changes(nodes: DataFrame) -> DataFrame:
    """Recovered prefixes (epoch, prefix, n, has_children) as rows of the recovered table."""
    path = tag_path(F.col("epoch"), F.col("prefix"))
    return (
        nodes.withColumns({"path": path, "chain": F.transform("prefix", split_measurement)})
        .select(
            "epoch",
            F.element_at("path", -1).alias("tag"),
            F.try_element_at("path", F.lit(-2)).alias("parent_tag"),
            F.element_at("chain", -1)["name"].alias("name"),
            F.element_at("chain", -1)["value"].alias("value"),
            "path",
            "chain",
            F.lit(None).cast("binary").alias("key"),
            F.col("n").alias("change"),
            "has_children",
        )
    )


@dataclass
class ClearBatch:
    """What a batch adds to the state; ``epochs`` are those that it touches, ``errors`` the messages it lost."""

    changes: DataFrame
    pending: DataFrame
    quarantine: DataFrame
    errors: int
    epochs: list[int]


QUARANTINE = "epoch SMALLINT, tag BINARY, threshold INT, layers ARRAY<STRING>, n BIGINT"


def process_batch(
    messages: DataFrame,
    recovered: DataFrame,
    pending: DataFrame,
    folder: str,
    total: int,
    max_failed: int = MAX_FAILED,
    max_failed_top: int = MAX_FAILED_TOP,
) -> ClearBatch:
    """One batch: its recovered changes, pending rows to append, and messages lost to malformed layers.

    ``messages``: epoch, layers, threshold, and n if a row stands for several. ``recovered``: the (epoch, tag) recovered so far, each once. ``pending``: all
    pending rows ever appended, dead ones included. ``total``: the number of messages. ``folder``: a shared work folder.

    When the tag of a malformed layer opens, its new messages are lost, and those that waited there go on waiting. A
    class of more than ``max_failed`` such messages, ``max_failed_top`` at the first layer, stops the run.
    """
    spark = messages.sparkSession

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    # The input is read and parsed once. Its few epochs keep the look-ups to their folders of the state.
    new = written(collapse(messages).withColumn("depth", F.lit(1)).withColumn("is_new", F.lit(True)), "new")
    epochs = sorted(row.epoch for row in new.select("epoch").distinct().collect())
    # Nothing below a tag that is not recovered is, so the tags of the new rows are all that can be found in the state.
    touched = written(_touched(new).distinct(), "touched")
    near = F.col("epoch").isin(epochs) & state.in_ranges(state.tag_ranges(touched))
    recovered, pending = (frame.filter(near) for frame in (recovered, pending))
    # Equal messages that began to wait in different batches go on as one row.
    waiting = state.lookup_pending(touched, recovered, pending).groupBy("epoch", "layers", "threshold", "depth").agg(
        F.sum("n").alias("n"), F.lit(False).alias("is_new")
    )
    live = new.unionByName(waiting)
    # Both passes below start from the collapsed rows.
    live = written(live, "live")
    heavy_from = heavy_rows(total + live.filter("NOT is_new").count())
    exploded = _by_prefix(live)

    # Sums use the prefix itself as their key; only the much fewer prefixes that result are given tags.
    classes = exploded.groupBy("epoch", "prefix", "threshold").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("rows"),
        F.max("is_new").alias("is_new"),
        F.max(F.col("d") < F.size("layers")).alias("has_children"),
        F.max("bad").alias("bad"),
    )
    known = recovered.select("epoch", "tag", F.lit(True).alias("known"))
    nodes = (
        classes.groupBy("epoch", "prefix")
        .agg(
            F.sum("n").alias("messages"),
            F.sum("rows").alias("n"),
            F.max("has_children").alias("has_children"),
            F.max(F.col("is_new") & reached(F.col("n"), F.col("threshold"))).alias("opened"),
            F.max("bad").alias("bad"),
            F.max("n").alias("largest"),
        )
        .withColumn("tag", prefix_tag(F.col("epoch"), F.col("prefix")))
        .join(known, ["epoch", "tag"], "left")
        .filter(F.col("opened") | F.col("known").isNotNull())
    )
    limit = F.when(F.size("prefix") == 1, max_failed_top).otherwise(max_failed)
    problem = F.concat(F.lit("no message opens for tag "), F.hex("tag"))
    checked = F.when(F.col("bad") & (F.col("largest") > limit), F.raise_error(problem).cast("boolean")).otherwise(F.col("bad"))
    opened = written(nodes.select("epoch", "prefix", "messages", "n", "has_children", checked.alias("bad")), "open")
    good = opened.filter("NOT bad")
    changes = as_changes(good.select("epoch", "prefix", F.col("messages").alias("n"), "has_children"))
    errors = opened.filter("bad").agg(F.coalesce(F.sum("messages"), F.lit(0))).first()[0]

    # A row waits below its deepest open prefix. The rows of a large open prefix are spread; afterwards the few rows
    # that come from one collapsed row meet again, most of them still on the same task.
    marked = spread_join(
        exploded.withColumn("spread", F.xxhash64("layers")),
        opened.select("epoch", "prefix", F.col("n").alias("rows"), F.lit(True).alias("is_open")),
        ["epoch", "prefix"],
        heavy_from,
        "spread",
        how="left",
        size="rows",
    )
    deepest = F.max(F.when(F.col("is_open"), F.col("d")))
    reached_rows = (
        marked.groupBy("epoch", "layers", "threshold", "is_new", F.col("depth").alias("started"))
        .agg(
            (F.coalesce(deepest, F.min("d") - 1) + 1).cast("int").alias("depth"),
            F.min("n").alias("n"),
            F.max(F.col("is_open").isNotNull() & F.col("bad")).alias("lost"),
        )
        .filter(F.col("lost") | (F.col("depth") <= F.size("layers")))
        .filter(F.col("is_new") | (F.col("depth") - F.col("lost").cast("int") > F.col("started")))
    )
    rows = written(reached_rows, "rows")
    at = F.when(F.col("lost"), F.col("depth") - 1).otherwise(F.col("depth"))
    tagged = rows.withColumn("tag", prefix_tag(F.col("epoch"), F.slice("layers", F.lit(1), at)))
    stuck = tagged.filter("NOT lost").select("epoch", "tag", "threshold", "layers", "depth", "n")
    lost = tagged.filter("lost").select("epoch", "tag", "threshold", "layers", "n")
    return ClearBatch(changes, stuck, lost, errors, epochs)
