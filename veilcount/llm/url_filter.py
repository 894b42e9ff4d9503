"""URL filters: a Bloom filter cascade, with built-in functions only.

The keys of the corpus are known: every url has its host, and for every rule length a few joined ends of the host and
beginnings of the path. The cascade's first level holds the listed keys. The next holds the keys of the corpus that pass
the first without being listed, the next the listed keys that pass the second, and so on until no key is wrong. A key
passes levels until one denies it; the level's number tells whether it is listed. That is exact for every key of the
corpus, needs no join over the pages, and all levels together are a few bits for each listed key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilcount.session import new_work_folder

#: Rules as host, path and verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Parts of host names that put a host on the list of the method.
TERMS = ("adult", "casino", "malware", "phish", "porn", "spam", "warez", "xxx")

BITS_PER_KEY, HASHES = 10, 7
#: Bits of one bitmap of Spark's aggregate; a level is made of whole ones.
BITMAP = 32_768
#: Most keys on a list. Its cascade then has about 12 MB, all levels together under 20 MB.
MOST_KEYS = 10_000_000


@dataclass
class Level:
    bits: bytes
    size: int
    seed: int

    def holds(self, key: Column) -> Column:
        """Whether all bits of a key are set. The expression stops at the first that is not."""
        found = F.lit(True)
        for at in reversed(range(HASHES)):
            place = _place(key, self.seed, at, self.size)
            byte = F.conv(F.hex(F.substring(F.lit(self.bits), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
            set_ = F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1
            found = F.when(set_, found).otherwise(F.lit(False))
        return found


def _place(key: Column, seed: int, at: int, size: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed * HASHES + at)), F.lit(size).cast("bigint"))


def _level(keys: DataFrame, count: int, seed: int) -> Level:
    """A Bloom filter of the column `key`; at most its own bits reach the driver."""
    size = BITMAP * math.ceil(max(1, count * BITS_PER_KEY) / BITMAP)
    places = keys.select(F.explode(F.array(*(_place(F.col("key"), seed, at, size) for at in range(HASHES)))).alias("place"))
    maps = (
        places.groupBy(F.floor(F.col("place") / BITMAP).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bits"))
        .collect()
    )
    bits = bytearray(size // 8)
    for row in maps:
        bits[row.part * BITMAP // 8 : (row.part + 1) * BITMAP // 8] = row.bits
    return Level(bytes(bits), size, seed)


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """The levels for the listed keys over the universe; both frames have the column `key`; repeated and null keys are
    dropped. An empty list makes an empty cascade, which lists nothing."""
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    count = listed.count()
    if count > MOST_KEYS:
        raise ValueError(f"{count} listed keys; join a list of more than {MOST_KEYS} on its key instead")
    others = universe.select("key").where(F.col("key").isNotNull()).distinct().join(listed, "key", "left_anti")
    turn, wait, levels = listed, others, []
    while count:
        level = _level(turn, count, len(levels))
        levels.append(level)
        wait = wait.where(level.holds(F.col("key")))  # those that it takes for its own
        turn, wait = wait, turn
        count = turn.count()
    return levels


def is_listed(levels: list[Level], key: Column) -> Column:
    """Exact for keys of the universe: the first level that denies a key has an odd place, counted from 0."""
    found = F.lit(len(levels) % 2 == 1)
    for at in reversed(range(len(levels))):
        found = F.when(levels[at].holds(key), found).otherwise(F.lit(at % 2 == 1))
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*+", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*+([^?#]*+)", 1)


def rule_keys(host: Column, path: Column, rules) -> Column:
    """Every end of the host that has as many labels as some rule, joined with every beginning of the path that is as
    long as some rule's."""
    labels = F.split(host, r"\.")
    ends = [
        (count, F.array_join(F.slice(labels, -count, count), ".")) for count in sorted({name.count(".") + 1 for name, _, _ in rules})
    ]
    keys = [
        F.when((F.size(labels) >= count) & (F.char_length(path) >= length), F.concat(end, F.substring(path, 1, length)))
        for count, end in ends
        for length in sorted({len(start) for _, start, _ in rules})
    ]
    return F.filter(F.array(*keys), lambda key: key.isNotNull())


def named_hosts(pages: DataFrame, terms=TERMS) -> DataFrame:
    """Hosts of the corpus with one of the terms in their name, as `key`: a list that grows with the corpus."""
    host, _ = host_and_path(F.col("url"))
    return pages.select(host.alias("key")).where(F.col("key").rlike("|".join(terms))).distinct()


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """`pages` with host, path, rule and verdict; listed: hosts to block where no rule fits, as `key`.

    The longest rule wins, between equally long ones that of the longer host. Null urls and urls without `://` have an
    empty host and path, which no rule fits; their verdict is allow unless the empty host is listed. Repeated rows are
    judged each; columns of the four names are replaced, all others stay.
    """
    spark = pages.sparkSession
    names = spark.createDataFrame([(host + path,) for host, path, _ in rules], "key string")
    folder = new_work_folder(spark, "url-lists")
    listed.select("key").union(names).write.parquet(folder + "/listed")
    host, path = host_and_path(F.col("url"))
    parsed = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    keys = F.concat(F.array("host"), rule_keys(F.col("host"), F.col("path"), rules))
    parsed.select(F.explode(keys).alias("key")).distinct().write.parquet(folder + "/universe")
    levels = build_cascade(spark.read.parquet(folder + "/listed"), spark.read.parquet(folder + "/universe"))

    fitting = F.filter(rule_keys(F.col("host"), F.col("path"), rules), lambda key: is_listed(levels, key))
    ranked = F.array_sort(
        F.transform(
            fitting, lambda key: F.struct(-F.char_length(key), -F.instr(key, "/"), key.alias("rule"))
        )
    )
    verdicts = F.create_map(*(F.lit(word) for host, path, verdict in rules for word in (host + path, verdict)))
    own = F.when(is_listed(levels, F.col("host")), "block").otherwise("allow")
    return parsed.withColumn("rule", F.try_element_at(ranked, F.lit(1))["rule"]).withColumn(
        "verdict", F.coalesce(F.element_at(verdicts, F.col("rule")), own)
    )


def report(pages: DataFrame) -> DataFrame:
    """Host, path, rule and verdict of every page, with the hosts named by `TERMS` as the list."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    return filter_urls(narrow, named_hosts(narrow)).select("page_id", "host", "path", "rule", "verdict")
