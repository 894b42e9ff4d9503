"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get the numbers 0 to n - 1 in the order of their key. A keyed Feistel network permutes the numbers below the next
power of two; a number that leaves the range walks on until it is back, so the range itself is permuted. The new
position alone gives the shard (position mod shards) and the slot (position div shards): the same seed, key order and
row count always give the same places, and any place can be computed, forwards and backwards, without the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilcount.session import new_work_folder

ROUNDS = 8
#: Fixed value: the Mersenne prime 2^31 - 1, in whose field the round function works.
PRIME = 2147483647
#: Each half of a position has at most 31 bits.
MOST_ROWS = 1 << 62


def round_keys(seed: str) -> list[tuple[int, int]]:
    """A multiplier and an addend below the prime for each round."""
    keys = []
    for at in range(ROUNDS):
        digest = hashlib.sha256(f"{seed}:{at}".encode()).digest()
        keys.append((int.from_bytes(digest[:4], "big") % (PRIME - 1) + 1, int.from_bytes(digest[4:8], "big") % PRIME))
    return keys


def _mix(half: np.ndarray, key: tuple[int, int], bits: int) -> np.ndarray:
    value = (half % PRIME * key[0] + key[1]) % PRIME
    value = (value * value + half) % PRIME
    return (value * key[0] + key[1]) % PRIME & ((1 << bits) - 1)


def _widths(rows: int) -> tuple[int, int]:
    bits = max(2, (rows - 1).bit_length())
    return bits // 2, bits - bits // 2


def _once(numbers: np.ndarray, rows: int, keys, back: bool) -> np.ndarray:
    high_bits, low_bits = _widths(rows)
    high, low = numbers >> low_bits, numbers & ((1 << low_bits) - 1)
    # The two halves keep their width and take turns: the same as swapping them in an even number of rounds.
    for at in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if at % 2 == 0:
            high = high ^ _mix(low, keys[at], high_bits)
        else:
            low = low ^ _mix(high, keys[at], low_bits)
    return (high << low_bits) | low


def permute(numbers: np.ndarray, rows: int, seed: str, back: bool = False) -> np.ndarray:
    """New positions of row numbers below `rows`; with `back`, the row numbers of positions."""
    if rows > MOST_ROWS:
        raise ValueError("more rows than 62 bits can number")
    keys = round_keys(seed)
    found = _once(np.asarray(numbers, np.int64), rows, keys, back)
    while (outside := found >= rows).any():
        found[outside] = _once(found[outside], rows, keys, back)
    return found


def number_rows(frame: DataFrame, order: list, columns: list[str]) -> tuple[DataFrame, int]:
    """`row`, the columns of `frame` as one struct, and `row_number`, from 0 in the order of `order`; the number of rows.

    The rows are dealt by ranges of the key, sorted and written once with their place in the partition; the partitions'
    offsets are one small row each. Rows that agree in the whole key take their numbers in any order.
    """
    spark = frame.sparkSession
    folder = new_work_folder(spark, "numbered")
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    names = [f"key{at}" for at in range(len(keys))]
    keyed = frame.select(F.struct(*(frame[name] for name in columns)).alias("row"), *(key.alias(name) for key, name in zip(keys, names)))
    place = F.monotonically_increasing_id()  # partition number above bit 33, place in the partition below
    dealt = keyed.repartitionByRange(*names).sortWithinPartitions(*names)
    dealt.select("row", place.alias("place")).write.parquet(folder)
    written = spark.read.parquet(folder).withColumn("part", F.shiftright("place", 33))
    counts = sorted((row["part"], row["count"]) for row in written.groupBy("part").count().collect())
    offsets, total = [], 0
    for part, count in counts:
        offsets.append((part, total))
        total += count
    starts = spark.createDataFrame(offsets, "part long, start long")  # as many rows as range partitions
    number = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return written.join(F.broadcast(starts), "part").select("row", number.alias("row_number")), total


def assign_shards(frame: DataFrame, order: list, shards: int = 24, seed: str = "shards") -> DataFrame:
    """`frame` with `shard` and `slot`; the shards' row counts differ by one at most, slots are gapless from 0.

    order: columns or expressions that name a row; null keys come first, rows with equal keys take neighbouring numbers
    in any order. Columns called shard or slot are replaced. An empty frame gives an empty result.
    """
    numbered, rows = number_rows(frame, order, [name for name in frame.columns if name not in ("shard", "slot")])

    @F.pandas_udf("long")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), rows, seed))

    placed = numbered.select("row", position("row_number").alias("position"))
    return placed.select(
        "row.*", (F.col("position") % shards).cast("int").alias("shard"), F.expr(f"position div {shards}").alias("slot")
    )


def shard_report(documents: DataFrame, shards: int = 24, seed: str = "shards") -> DataFrame:
    """Size, checksum and place of every document under the law `rows`; a null text has no bytes.

    Only the narrow columns are shuffled. Row numbers follow doc_id, then the checksum and the size.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    placed = assign_shards(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
