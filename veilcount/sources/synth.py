"""Measurement sources for load and test data: delimited files, generated sets, files of encoded messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The defaults of generated measurements.
LAYER_COUNT = 7
COPIES = 50


def csv_measurements(spark: SparkSession, path: str) -> DataFrame:
    """layers and ``n`` per line: the header names the layers, the last column is how often the measurement occurs."""
    lines = spark.read.csv(path, header=True)
    *names, total = lines.columns
    cells = [F.concat(F.lit(f"{c}|"), F.trim(F.coalesce(F.col(f"`{c}`"), F.lit("")))) for c in names]
    return lines.select(F.array(*cells).alias("layers"), F.trim(F.col(f"`{total}`")).cast("bigint").alias("n"))


def repeat(measurements: DataFrame) -> DataFrame:
    """One row per message instead of a count, for inputs that need single messages."""
    return measurements.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).drop("n")


def hashed_u32(*parts: Column) -> Column:
    """A number below 2^32 that depends only on the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("/", *parts), 256), 1, 8), 16, 10).cast("bigint")


def generated_messages(uniques: DataFrame, key: str, copies: int = COPIES, layer_count: int = LAYER_COUNT) -> DataFrame:
    """``copies`` equal messages of ``layer_count`` layers for each row of ``uniques``.

    Layer values are hashed from the key, so a retried task produces the same messages.
    """
    layers = [
        F.concat(F.lit(f"layer{i}|"), hashed_u32(F.col(key).cast("string"), F.lit(str(i))).cast("string"))
        for i in range(layer_count)
    ]
    # The layers are hashed before the rows are repeated.
    measurements = uniques.select(key, F.array(*layers).alias("layers"))
    return measurements.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))


def message_lines(spark: SparkSession, path: str) -> DataFrame:
    """Submissions from a file with one encoded message per line."""
    return spark.read.text(path).select(
        F.lit(None).cast("string").alias("channel"),
        F.col("value").cast("binary").alias("body"),
        F.lit(None).cast("string").alias("revision"),
        F.lit(None).cast("string").alias("threshold"),
    )
