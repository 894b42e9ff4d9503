"""Reports over recovered state rows.

Every row stores its path of tags and its chain of (name, value) from the root, so a report never recurses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilcount.functions.epochs import EpochClock, is_expired, rolled_clock, survey_date
from veilcount.functions.measurements import measurement_json

#: Layers of the longest chain that is followed by parent pointers.
DEEPEST = 1_024


def nonzero(recovered: DataFrame, epochs: list[int] | None = None) -> DataFrame:
    """Rows with messages left, for the given epochs."""
    rows = recovered.filter(F.col("count") > 0)
    return rows if epochs is None else rows.filter(F.col("epoch").isin([int(e) for e in epochs]))


def visible(recovered: DataFrame) -> DataFrame:
    """Rows that a walk from the root reaches: no row above is missing, has a count of 0 or is marked as a leaf.

    Of the rows that block a walk, the lowest is the parent of a row that exists, so parents alone are looked up. They
    are few as a rule, and only below them are paths compared. ``recovered`` is read several times: pass a written table.
    """
    parents = recovered.filter(F.col("parent_tag").isNotNull()).select("epoch", F.col("parent_tag").alias("above")).distinct()
    passable = recovered.filter((F.col("count") != 0) & F.col("has_children")).select("epoch", F.col("tag").alias("above"))
    blocked = parents.join(passable, ["epoch", "above"], "left_anti")
    held = recovered.filter(F.col("count") != 0)
    if blocked.isEmpty():
        return held
    above = F.explode(F.expr("slice(path, 1, size(path) - 1)")).alias("above")
    hidden = recovered.select("epoch", "tag", above).join(blocked, ["epoch", "above"], "left_semi")
    return held.join(hidden.select("epoch", "tag"), ["epoch", "tag"], "left_anti")


def full_report(recovered: DataFrame) -> DataFrame:
    """Fully opened chains: (epoch, tag, path, chain, total)."""
    rows = visible(recovered).filter(~F.col("has_children"))
    return rows.select("epoch", "tag", "path", "chain", F.col("count").alias("total"))


def partial_report(recovered: DataFrame) -> DataFrame:
    """Leaves, and inner rows with the messages that none of their children holds."""
    rows = visible(recovered)
    of_children = (
        rows.filter(F.col("parent_tag").isNotNull())
        .groupBy("epoch", F.col("parent_tag").alias("tag"))
        .agg(F.sum("count").alias("below"))
    )
    left = rows.join(of_children, ["epoch", "tag"], "left").withColumn(
        "total",
        F.when(F.col("has_children"), F.col("count") - F.coalesce("below", F.lit(0).cast("bigint"))).otherwise(
            F.col("count")
        ),
    )
    return left.filter(~F.col("has_children") | (F.col("total") > 0)).select("epoch", "tag", "path", "chain", "total")


def reported_changes(emitted: DataFrame) -> DataFrame:
    """What a report takes from the reported rows and all rows above them: (epoch, tag, change)."""
    return (
        emitted.select("epoch", F.explode("path").alias("tag"), "total")
        .groupBy("epoch", "tag")
        .agg((-F.sum("total")).alias("change"))
    )


def chains_from_parents(recovered: DataFrame, folder: str, deepest: int = DEEPEST) -> DataFrame:
    """(epoch, tag, chain) of rows that store no path: epoch, tag, parent_tag, name and value, one row per epoch and tag.

    Pointers are doubled: in each round a row's chain takes in the chain of the row above it and points to that row's own
    parent, so a chain of d layers takes about log2(d) joins. Rows whose chain does not reach a root are left out, as a
    walk from the root never meets them. A cycle, or a chain of more than ``deepest`` layers, raises ValueError.
    ``folder`` is a shared work folder; each round is a written table there.
    """
    spark = recovered.sparkSession
    cell = F.array(F.struct("name", "value"))
    rows = recovered.select("epoch", "tag", F.col("parent_tag").alias("up"), cell.alias("chain"))
    layers = 1  # of every row that has not reached a root
    while True:
        rows.write.mode("overwrite").parquet(f"{folder}/chains-{layers}")
        rows = spark.read.schema(rows.schema).parquet(f"{folder}/chains-{layers}")
        rooted, climbing = rows.filter(F.col("up").isNull()), rows.filter(F.col("up").isNotNull())
        if climbing.isEmpty():
            return _within(rows, deepest).select("epoch", "tag", "chain")
        if layers >= deepest:
            raise ValueError(f"a cycle, or a chain of more than {deepest} layers")
        above = rows.select("epoch", F.col("tag").alias("up"), F.col("up").alias("next"), F.col("chain").alias("before"))
        climbed = climbing.join(above, ["epoch", "up"]).select(
            "epoch", "tag", F.col("next").alias("up"), F.concat("before", "chain").alias("chain")
        )
        rows = rooted.unionByName(climbed)
        layers *= 2


def _within(rows: DataFrame, deepest: int) -> DataFrame:
    problem = F.lit(f"a chain of more than {deepest} layers")
    return rows.withColumn("chain", F.when(F.size("chain") > deepest, F.raise_error(problem)).otherwise(F.col("chain")))


def residual_counts(recovered: DataFrame, emitted: DataFrame) -> DataFrame:
    """Counts that are left after a report."""
    return recovered.join(reported_changes(emitted), ["epoch", "tag"], "left").select(
        *[c for c in recovered.columns if c != "count"],
        (F.col("count") + F.coalesce("change", F.lit(0).cast("bigint"))).alias("count"),
    )


def measurements(emitted: DataFrame, clock: EpochClock, now: F.Column) -> DataFrame:
    """(epoch, total, survey_date, json) of the emitted rows."""
    at = rolled_clock(now, clock.epoch_column(), clock.next_column(), clock.length)
    date = survey_date(F.col("epoch"), at["epoch"], at["next_time"], clock.length)
    dated = emitted.withColumn("survey_date", date)
    json = measurement_json(F.col("chain"), F.col("total"), clock.date_field, F.col("survey_date"))
    return dated.select("epoch", "total", "survey_date", json.alias("json"))


def expired_rows(recovered: DataFrame, clock: EpochClock, now: F.Column) -> DataFrame:
    """Rows of epochs that have reached their lifetime."""
    at = rolled_clock(now, clock.epoch_column(), clock.next_column(), clock.length)
    return recovered.filter(is_expired(F.col("epoch"), at["epoch"], clock.lifetime))
