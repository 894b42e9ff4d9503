"""Joins in which a few keys hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALLEST_HEAVY = 100_000
MOST_HEAVY_KEYS = 10_000


def heavy_rows(total_rows: int) -> int:
    """From how many rows on a key is heavy. Per layer, at most ``MOST_HEAVY_KEYS`` keys can have that many."""
    return max(SMALLEST_HEAVY, -(-total_rows // MOST_HEAVY_KEYS))


def spread_join(
    rows: DataFrame,
    keyed: DataFrame,
    on: list[str],
    heavy_from: int,
    spread_by: str,
    how: str = "inner",
    size: str = "n",
) -> DataFrame:
    """Join (inner or left) of ``rows`` with ``keyed``, which has one row per key and the key's number of rows in the
    column ``size``.

    Rows of a heavy key are spread by ``spread_by`` over as many tasks as its size holds ``heavy_from``; the key's row is
    repeated once per salt. ``keyed`` is read more than once, so it should be a written table.
    """
    salts = F.greatest(F.floor(F.col(size) / F.lit(heavy_from)), F.lit(1)).cast("int")
    heavy = few(keyed.filter(F.col(size) >= F.lit(heavy_from)).select(*on, salts.alias("salts")))
    place = F.pmod(F.xxhash64(spread_by), F.coalesce("salts", F.lit(1))).cast("int")
    salted = rows.join(heavy, on, "left").withColumn("salt", place)
    every_salt = F.sequence(F.lit(0), salts - 1)
    repeated = keyed.withColumn("salt", F.explode(every_salt)).drop(size)
    return salted.drop("salts").join(repeated, [*on, "salt"], how).drop("salt")


def few(heavy: DataFrame) -> DataFrame:
    """Keys to be joined with many rows: broadcast once they are counted to be few, else joined as Spark sees fit."""
    return F.broadcast(heavy) if heavy.count() <= MOST_HEAVY_KEYS else heavy


def without_heavy(rows: DataFrame, keyed: DataFrame, on: list[str], heavy_from: int) -> DataFrame:
    """``rows`` without those of heavy keys in ``keyed`` (one row per key, with its number of rows ``n``)."""
    return rows.join(few(keyed.filter(F.col("n") >= F.lit(heavy_from)).select(*on)), on, "left_anti")
