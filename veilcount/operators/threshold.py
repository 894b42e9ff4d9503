"""Threshold aggregation over clear messages.

A message has an epoch, an ordered array of layers (``name|value`` texts) and a threshold. A *prefix* is the first d
layers of a message. Each prefix counts its messages per threshold class, and it is *recovered* once one class reaches
its own threshold; classes are never added together. A threshold below 2 asks for no key, so its class never opens a
prefix. All messages of a recovered prefix count towards it. A layer that is no ``name|value`` text is never revealed,
and nothing below it is.

A class of a longer prefix is never larger than the same class of its parent, so recovered prefixes form a tree that
starts at the root. That makes the whole computation a chain of sums over prefixes: no join and no per-message
look-up, every shuffle carries sums already combined on the map side, and a prefix that holds most messages is still
one partial sum per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Fixed value: the smallest threshold whose class can open a prefix.
LEAST_THRESHOLD = 2


def reached(n: Column, threshold: Column) -> Column:
    """Whether a class of n messages opens its prefix."""
    return (threshold >= LEAST_THRESHOLD) & (n >= threshold)


def well_formed(layers: Column) -> Column:
    """How many layers there are before the first that is no ``name|value`` text."""
    bad = F.array_position(F.transform(layers, lambda text: F.coalesce(F.regexp_count(text, F.lit("[|]")) != 1, F.lit(True))), True)
    return F.when(bad > 0, (bad - 1).cast("int")).otherwise(F.size(layers))


def collapse(messages: DataFrame) -> DataFrame:
    """One row per equal (epoch, layers, threshold) with its number of messages ``n``."""
    count = F.sum("n") if "n" in messages.columns else F.count(F.lit(1))
    return messages.groupBy("epoch", "layers", "threshold").agg(count.alias("n"))


def prefixes(rows: DataFrame) -> DataFrame:
    """One row per collapsed row and depth of well-formed layers: the prefix, whether the message goes on below it."""
    good = well_formed(F.col("layers"))
    depths = F.when(F.col("good") > 0, F.sequence(F.lit(1), F.col("good"))).otherwise(F.array())
    return rows.withColumn("good", good).withColumn("depth", F.explode(depths)).select(
        "epoch",
        F.expr("slice(layers, 1, depth)").alias("prefix"),
        "threshold",
        "n",
        (F.col("depth") < F.size("layers")).alias("goes_on"),
    )


def class_counts(messages: DataFrame) -> DataFrame:
    """Messages per (epoch, prefix, threshold class), over all prefixes of all messages."""
    return (
        prefixes(collapse(messages))
        .groupBy("epoch", "prefix", "threshold")
        .agg(F.sum("n").alias("n"), F.max("goes_on").alias("goes_on"))
    )


def class_counts_by_sets(messages: DataFrame, deepest: int | None = None) -> DataFrame:
    """As ``class_counts``, by grouping sets over one column per layer: a rollup whose every level keeps its own rows.

    ``deepest`` is the number of layers of the longest message, looked up if it is not given. What lies below a malformed
    layer, or below a message's last one, is no level of that message.
    """
    rows = collapse(messages).withColumn("good", well_formed(F.col("layers")))
    if deepest is None:
        deepest = rows.agg(F.max("good")).first()[0] or 0
    names = [f"layer{at}" for at in range(max(1, deepest))]
    cells = [F.when(F.col("good") > at, F.get("layers", F.lit(at))).alias(name) for at, name in enumerate(names)]
    wide = rows.select("epoch", "threshold", "n", F.size("layers").alias("length"), *cells)
    sets = [["epoch", "threshold", *names[: depth + 1]] for depth in range(len(names))]
    depth = sum((1 - F.grouping(name) for name in names), F.lit(0)).cast("int")
    found = wide.groupingSets(sets, "epoch", "threshold", *names).agg(
        F.sum("n").alias("n"), F.max("length").alias("length"), depth.alias("depth")
    )
    present = F.filter(F.array(*names), lambda cell: cell.isNotNull())
    return found.withColumn("prefix", present).filter(F.size("prefix") == F.col("depth")).select(
        "epoch", "prefix", "threshold", "n", (F.col("length") > F.col("depth")).alias("goes_on")
    )


def prefix_nodes(classes: DataFrame) -> DataFrame:
    """One row per (epoch, prefix): all its messages, whether it is recovered, whether it has children."""
    return classes.groupBy("epoch", "prefix").agg(
        F.sum("n").alias("n"),
        F.max(reached(F.col("n"), F.col("threshold"))).alias("recovered"),
        F.max("goes_on").alias("has_children"),
        F.min(F.when(reached(F.col("n"), F.col("threshold")), F.col("threshold"))).alias("recovery_threshold"),
    )


def recovered_nodes(messages: DataFrame) -> DataFrame:
    return prefix_nodes(class_counts(messages)).filter("recovered").drop("recovered")


def residuals(nodes: DataFrame) -> DataFrame:
    """Messages of each recovered prefix that no recovered child took over.

    Every node adds its count to itself and takes it from its parent, which needs one sum instead of a self-join.
    """
    own = F.struct("prefix", F.col("n").alias("change"), F.col("has_children").alias("has_children"))
    to_parent = F.struct(
        F.expr("slice(prefix, 1, size(prefix) - 1)").alias("prefix"),
        (-F.col("n")).alias("change"),
        F.lit(None).cast("boolean").alias("has_children"),
    )
    return (
        nodes.select("epoch", F.inline(F.array(own, to_parent)))
        .filter(F.size("prefix") > 0)
        .groupBy("epoch", "prefix")
        .agg(F.sum("change").alias("total"), F.max("has_children").alias("has_children"))
    )


def reveal(messages: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """What all messages reveal: (epoch, prefix, total, is_partial). ``classes`` replaces their ``class_counts``.

    A prefix without children is a full measurement. Messages stuck at a prefix with children are a partial one,
    to be reported when the epoch expires.
    """
    nodes = prefix_nodes(class_counts(messages) if classes is None else classes).filter("recovered").drop("recovered")
    return (
        residuals(nodes)
        .filter(F.col("total") > 0)
        .select("epoch", "prefix", "total", F.col("has_children").alias("is_partial"))
    )


def rounds(messages: DataFrame) -> DataFrame:
    """Progress by layer: round d opens the recovered prefixes of depth d, until a round opens nothing.

    A message whose prefix of depth d is recovered and that goes on is what round d+1 receives.
    """
    rows = prefixes(collapse(messages)).withColumn("round", F.size("prefix"))
    classes = rows.groupBy("epoch", "round", "prefix", "threshold").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("goes_on"), F.col("n")).otherwise(0)).alias("next_n")
    )
    nodes = classes.groupBy("epoch", "round", "prefix").agg(
        F.sum("n").alias("n"),
        F.sum("next_n").alias("next_n"),
        F.max(reached(F.col("n"), F.col("threshold"))).alias("recovered"),
    )
    return (
        nodes.filter("recovered")
        .groupBy("epoch", "round")
        .agg(
            F.count(F.lit(1)).alias("tags_opened"),
            F.sum("n").alias("messages_opened"),
            F.sum("next_n").alias("messages_passed_on"),
        )
    )


def eligible_classes(new_counts: DataFrame, pending_counts: DataFrame, keys: list[str]) -> DataFrame:
    """Classes that can be recovered now: present among the new messages, and new plus pending reach the threshold.

    Both inputs hold ``keys + [threshold, n]``. The smallest such threshold of a tag is ``recovery_threshold``.
    """
    both = new_counts.select(*keys, "threshold", "n", F.lit(True).alias("is_new")).unionByName(
        pending_counts.select(*keys, "threshold", "n", F.lit(False).alias("is_new"))
    )
    return (
        both.groupBy(*keys, "threshold")
        .agg(F.sum("n").alias("n"), F.max("is_new").alias("is_new"))
        .filter(F.col("is_new") & reached(F.col("n"), F.col("threshold")))
        .select(*keys, "threshold", "n")
    )


def thresholds_present(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The set of threshold classes per tag, over new and pending messages.

    Distinct pairs come first, so the collected set is bounded by the number of possible thresholds.
    """
    return (
        counts.select(*keys, "threshold")
        .distinct()
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("threshold")).alias("thresholds"))
    )
