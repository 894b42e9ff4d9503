"""Running sums over long sorted groups without putting a group into one task.

Rows are range-partitioned by the full sort key, so that a group of any size is spread over many chunks. Windows run
inside a chunk; between chunks only one summary row per chunk and group is carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilcount.session import shared_folder


def ordered_chunks(rows: DataFrame, order: list[str], chunks: int | None = None) -> DataFrame:
    """Add ``chunk``, which grows with the sort order.

    The result is checkpointed: the range bounds are sampled, and every later step must see the same ones. A unique
    last order column lets equal values be split.
    """
    shared_folder(rows.sparkSession)
    placed = rows.repartitionByRange(chunks, *order) if chunks else rows.repartitionByRange(*order)
    return placed.withColumn("chunk", F.spark_partition_id()).checkpoint()


def _carried(chunked: DataFrame, group: list[str], value: Column) -> DataFrame:
    """For each (group, chunk): the sum of all earlier chunks. The window runs over one row per chunk."""
    sums = chunked.groupBy(*group, "chunk").agg(F.sum(value).alias("s"))
    earlier = Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, "chunk", F.coalesce(F.sum("s").over(earlier), F.lit(0).cast("bigint")).alias("carried"))


def running_sum(chunked: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the group up to and including each row."""
    inside = Window.partitionBy(*group, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumn("local", F.sum(value).over(inside))
    joined = local.join(_carried(chunked, group, value), [*group, "chunk"])
    return joined.withColumn(name, F.col("local") + F.col("carried")).drop("local", "carried")


def with_previous(chunked: DataFrame, group: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """Add the value of ``column`` in the row before, NULL for the first row of a group."""
    inside = Window.partitionBy(*group, "chunk").orderBy(*order)
    last = chunked.groupBy(*group, "chunk").agg(F.max_by(column, F.struct(*order)).alias("last"))
    before = last.select(
        *group, "chunk", F.lag("last").over(Window.partitionBy(*group).orderBy("chunk")).alias("from_before")
    )
    local = chunked.withColumn("local", F.lag(column).over(inside))
    return (
        local.join(before, [*group, "chunk"])
        .withColumn(name, F.coalesce("local", "from_before"))
        .drop("local", "from_before")
    )
