"""Threshold aggregation over sealed messages.

A sealed message shows a tag, one share of the tag's key and an encrypted layer. The layer opens with the key, which
takes a threshold's worth of shares, and holds the measurement text and the key of the next sealed layer. Layers are
opened round by round; what a round opens is written to a table, from which the next round reads.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilcount.functions import shares as sh
from veilcount.functions.polynomials import share_values
from veilcount.functions.tags import tag_path
from veilcount.functions.text import base64_text, split_measurement
from veilcount.operators import state
from veilcount.operators.skew import heavy_rows, spread_join, without_heavy
from veilcount.operators.state import MAX_FAILED, MAX_FAILED_TOP
from veilcount.operators.threshold import eligible_classes
from veilcount.session import drop_folder, shuffles_dropped

PENDING = "epoch SMALLINT, tag BINARY, threshold INT, msg_id STRING, x BIGINT, y ARRAY<BIGINT>, ct BINARY, inner BINARY"
QUARANTINE = "epoch SMALLINT, tag BINARY, threshold INT, msg_id STRING"
_OUTER = "tag STRING, x BIGINT, y ARRAY<BIGINT>, ct STRING, inner STRING"
_CONTENT = "m STRING, k STRING"
_KEYS = ["epoch", "tag"]
_CLASS = ["epoch", "tag", "threshold"]
#: Messages of a batch whose rounds are written at once; a larger batch is opened part by part.
PART_MESSAGES = 2_000_000
#: Outer tags are dealt into so many buckets by their hash, and neighbouring buckets make a part.
BUCKETS = 4096


# -- sealing -----------------------------------------------------------------------------------------------------------


def _nonce(*parts: Column) -> Column:
    """12 bytes that differ per message and layer, so that a retried task seals the same bytes."""
    return F.substring(F.unhex(F.sha2(F.concat_ws("/", *parts), 256)), 1, 12)


def _encrypt(text: Column, key: Column, nonce: Column) -> Column:
    return F.aes_encrypt(text.cast("binary"), key, F.lit("GCM"), F.lit("DEFAULT"), nonce)


def with_outer_tag(messages: DataFrame, secret: str) -> DataFrame:
    """Clear messages with the tag that ``seal`` shows. Once written, sealed messages are picked by it before they are sealed."""
    return messages.withColumn("outer_tag", F.get(tag_path(F.col("epoch"), F.slice("layers", 1, 1), secret), F.lit(0)))


def seal(messages: DataFrame, secret: str, max_depth: int) -> DataFrame:
    """Seal clear messages (epoch, msg_id, layers, threshold); no message may have more than ``max_depth`` layers.

    Their outer tag is taken from ``outer_tag`` if they have it.
    """
    layers, msg_id, x = F.col("layers"), F.col("msg_id"), F.col("x")
    tagged = messages.withColumn("path", tag_path(F.col("epoch"), layers, secret)).withColumn("x", sh.share_point(msg_id))
    depths = {depth: F.get("path", F.lit(depth - 1)) for depth in range(1, max_depth + 1)}
    if "outer_tag" in messages.columns:
        depths[1] = F.col("outer_tag")
    tagged = tagged.withColumns({f"limbs_{depth}": sh.key_limbs(tag, secret) for depth, tag in depths.items()})
    values = {
        f"y_{depth}": share_values(
            sh.class_seed(tag, F.col("threshold"), secret), F.col("threshold").cast("int"), x, F.col(f"limbs_{depth}")
        )
        for depth, tag in depths.items()
    }
    tagged = tagged.withColumns(values)
    inner = F.lit(None).cast("binary")
    fields: dict[str, Column] = {}
    for depth in range(max_depth, 0, -1):
        number = F.lit(str(depth))
        next_key = F.unhex(F.sha2(F.concat_ws("/", F.lit(secret), msg_id, number, F.lit("next")), 256))
        goes_on = F.size(layers) > depth
        content = F.to_json(
            F.struct(F.get(layers, F.lit(depth - 1)).alias("m"), F.when(goes_on, base64_text(next_key)).alias("k"))
        )
        key = sh.key_of_limbs(F.col(f"limbs_{depth}"))
        fields = {
            "tag": depths[depth],
            "x": x,
            "y": F.col(f"y_{depth}"),
            "ct": _encrypt(content, key, _nonce(msg_id, number, F.lit("content"))),
            "inner": F.when(goes_on, inner),
        }
        if depth > 1:
            text = F.to_json(
                F.struct(
                    base64_text(fields["tag"]).alias("tag"),
                    fields["x"].alias("x"),
                    fields["y"].alias("y"),
                    base64_text(fields["ct"]).alias("ct"),
                    base64_text(fields["inner"]).alias("inner"),
                )
            )
            outer_key = F.unhex(F.sha2(F.concat_ws("/", F.lit(secret), msg_id, F.lit(str(depth - 1)), F.lit("next")), 256))
            inner = _encrypt(text, outer_key, _nonce(msg_id, number, F.lit("layer")))
    return tagged.select(
        F.col("epoch").cast("smallint").alias("epoch"),
        F.col("threshold").cast("int").alias("threshold"),
        "msg_id",
        *[column.alias(name) for name, column in fields.items()],
    )


# -- keys --------------------------------------------------------------------------------------------------------------


def share_sample(shares: DataFrame, salt: int = 0, highest: int | None = None) -> DataFrame:
    """The shares of k + k/3 different x per class, or of all if there are fewer, with ``ct`` if ``shares`` has it.

    ``highest`` is the highest threshold, looked up if it is not given. Its limit is a number, which Spark applies to each
    partition before the shuffle, so a class of any size sends only few shares per task (up to a threshold of 750, from
    where on Spark ranks after the shuffle). Copies of a share have one rank and collapse afterwards. ``salt`` draws
    another sample.
    """
    if highest is None:
        highest = shares.agg(F.max("threshold")).first()[0] or 0
    order = Window.partitionBy(*_CLASS).orderBy(F.xxhash64("x", F.lit(salt)), "x")
    columns = ["x", "y", *(["ct"] if "ct" in shares.columns else [])]
    ranked = shares.select(*_CLASS, *columns).withColumn("rank", F.dense_rank().over(order))
    own_limit = F.col("rank") <= F.col("threshold") + F.floor(F.col("threshold") / 3)
    return ranked.filter((F.col("rank") <= highest + highest // 3) & own_limit).drop("rank").distinct()


def _different_shares(sample: DataFrame, *more: Column) -> DataFrame:
    """One row per class with the array ``shares`` of x and y, by x and without repeated x."""
    listed = sample.groupBy(*_CLASS).agg(F.sort_array(F.collect_set(F.struct("x", "y"))).alias("shares"), *more)
    different = F.filter("shares", lambda s, at: (at == 0) | (F.get(F.col("shares"), at - 1)["x"] != s["x"]))
    return listed.withColumn("shares", different)


def _key_of(shares: Column) -> Column:
    """The key that so many shares as the threshold give; NULL with fewer, or for a threshold below 2."""
    key = sh.key_of_limbs(sh.secret_at_zero(shares))
    return F.when((F.size(shares) == F.col("threshold")) & (F.col("threshold") >= 2), key)


def recover_keys(sample: DataFrame) -> DataFrame:
    """(class, key) from the first sampled shares; the key is NULL when fewer than k different shares are left."""
    usable = _different_shares(sample).withColumn("usable", F.slice("shares", F.lit(1), F.col("threshold")))
    return usable.select(*_CLASS, _key_of(F.col("usable")).alias("key"))


def tested_keys(sample: DataFrame, folder: str) -> DataFrame:
    """(class, key) from a sample with ``ct``: a key that opens a sampled message, NULL if the shares give none.

    The first k shares are tried first. Where their key opens nothing, the sample is cut into blocks of half as many shares
    as there are to spare, and every pair of blocks is left out in turn. So bad shares in any two blocks, any two of them
    at least, do no harm. Of several keys the one that opens most is taken. If nothing opens but all subsets give one key, the
    shares are sound and the messages are not; the key is kept and opening decides. ``folder`` is a work folder.
    """
    spark = sample.sparkSession
    cts = F.collect_set("ct").alias("cts")
    first = _different_shares(sample, cts).withColumn("usable", F.slice("shares", F.lit(1), F.col("threshold")))
    opens = F.size(F.filter("cts", lambda ct: F.try_aes_decrypt(ct, F.col("key"), F.lit("GCM")).isNotNull()))
    first = first.withColumn("key", _key_of(F.col("usable"))).withColumn("opens", F.when(F.col("key").isNotNull(), opens))
    # Shares are only kept where they are tried again.
    bad = (F.col("opens") == 0) & (F.size("shares") > F.col("threshold"))
    kept = [F.when(bad, F.col(name)).alias(name) for name in ("shares", "cts")]
    first.select(*_CLASS, "key", "opens", *kept).write.mode("overwrite").parquet(f"{folder}/first")
    first = spark.read.parquet(f"{folder}/first")
    bad = first.filter("shares IS NOT NULL")
    if bad.isEmpty():
        return first.select(*_CLASS, F.when(F.col("opens") > 0, F.col("key")).alias("key"))
    block = F.greatest(F.lit(1), F.floor((F.size("shares") - F.col("threshold")) / 2)).cast("int")
    blocks = F.sequence(F.lit(0), F.floor((F.size("shares") - 1) / F.col("block")).cast("int"))
    cut = bad.drop("key", "opens").withColumn("block", block).withColumn("one", F.explode(blocks))
    cut = cut.withColumn("other", F.explode(blocks)).filter("one <= other")
    left = F.filter("shares", lambda s, at: ~F.floor(at / F.col("block")).isin(F.col("one"), F.col("other")))
    # A class has some 45 pairs, each some milliseconds of arithmetic: dealt anew over all tasks.
    cut = cut.repartition(spark.sparkContext.defaultParallelism, *_CLASS, "one", "other")
    cut = cut.withColumn("usable", F.slice(left, F.lit(1), F.col("threshold"))).withColumn("key", _key_of(F.col("usable")))
    tried = cut.filter(F.col("key").isNotNull()).withColumn("opens", opens)
    first_key = F.struct("opens", "key")
    best = tried.groupBy(*_CLASS).agg(
        F.max(first_key).alias("best"), F.count_distinct("key").alias("keys"), F.count(F.lit(1)).alias("subsets")
    )
    sound = (F.col("best.opens") > 0) | ((F.col("keys") == 1) & (F.col("subsets") > 1))
    best = best.select(*_CLASS, F.when(sound, F.col("best.key")).alias("better"))
    return first.join(best, _CLASS, "left").select(*_CLASS, F.when(F.col("opens") > 0, F.col("key")).otherwise(F.col("better")).alias("key"))


def tag_keys(class_keys: DataFrame) -> DataFrame:
    """One key per tag: that of the smallest threshold class which gave one."""
    return (
        class_keys.filter(F.col("key").isNotNull())
        .groupBy(*_KEYS)
        .agg(F.min(F.struct("threshold", "key")).alias("best"))
        .select(*_KEYS, "best.key")
    )


# -- opening -----------------------------------------------------------------------------------------------------------


def open_layer(keyed: DataFrame) -> DataFrame:
    """Open messages that carry their tag's ``key``: flags, the measurement text, and the next sealed layer."""
    content = F.from_json(F.try_aes_decrypt("ct", "key", F.lit("GCM")).cast("string"), _CONTENT)
    next_key = F.try_to_binary(F.col("content.k"), F.lit("base64"))
    outer = F.from_json(F.try_aes_decrypt("inner", next_key, F.lit("GCM")).cast("string"), _OUTER)
    return (
        keyed.withColumn("content", content)
        .withColumn("next", outer)
        .select(
            *_CLASS,
            "parent_tag",
            "msg_id",
            F.col("content.m").isNotNull().alias("opened"),
            F.col("content.k").isNotNull().alias("has_next"),
            F.col("next.tag").isNotNull().alias("next_opened"),
            F.col("content.m").alias("measurement"),
            F.unbase64("next.tag").alias("next_tag"),
            F.col("next.x").alias("next_x"),
            F.col("next.y").alias("next_y"),
            F.unbase64("next.ct").alias("next_ct"),
            F.unbase64("next.inner").alias("next_inner"),
        )
    )


def next_layer(opened: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """The messages of the next round: what opened in classes that did not fail, with this tag as the parent."""
    going_on = opened.filter("next_opened")
    return (going_on if failed is None else going_on.join(failed, _CLASS, "left_anti")).select(
        "epoch",
        F.col("next_tag").alias("tag"),
        "threshold",
        "msg_id",
        *[F.col(f"next_{c}").alias(c) for c in ("x", "y", "ct", "inner")],
        F.col("tag").alias("parent_tag"),
    )


def class_outcomes(flags: DataFrame, max_failed: int = MAX_FAILED, max_failed_top: int = MAX_FAILED_TOP) -> DataFrame:
    """What became of each class: messages, errors, the measurement of its first opened message, and whether it failed.

    The first message is the one whose number has the smallest hash. A class fails if no message opens or the first one is not a ``name|value`` text. Messages that do not open
    count as errors only if some message of the class goes on to a next layer.
    """
    broken = ~F.col("opened") | (F.col("has_next") & ~F.col("next_opened"))
    # Messages of a class have the same text, so the first step leaves few rows, and it only sums numbers.
    by_text = flags.groupBy(*_CLASS, "parent_tag", "measurement").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("opened").alias("n_opened"),
        F.max(F.col("opened") & F.col("has_next")).alias("goes_on"),
        F.count_if(broken).alias("broken"),
        F.min(F.when(F.col("opened"), F.xxhash64("msg_id"))).alias("order"),
    )
    summed = by_text.groupBy(*_CLASS).agg(
        F.sum("n").alias("n"),
        F.sum("n_opened").alias("n_opened"),
        F.max("goes_on").alias("goes_on"),
        F.sum("broken").alias("broken"),
        F.min(F.when(F.col("order").isNotNull(), F.struct("order", "measurement"))).alias("first"),
        F.min("parent_tag").alias("parent_tag"),
    )
    parts = split_measurement(F.col("first.measurement"))
    failed = (F.col("n_opened") == 0) | parts.isNull()
    # The parent belongs to the tag: a class of waiting messages only does not carry it. A tag has few classes.
    parent = F.min("parent_tag").over(Window.partitionBy(*_KEYS))
    limit = F.when(F.col("parent_tag").isNull(), max_failed_top).otherwise(max_failed)
    return summed.withColumn("parent_tag", parent).select(
        *_CLASS,
        "parent_tag",
        "n",
        "n_opened",
        "goes_on",
        parts["name"].alias("name"),
        parts["value"].alias("value"),
        failed.alias("failed"),
        (failed & (F.col("n") > limit)).alias("too_many"),
        F.when(failed, F.col("n")).when(F.col("goes_on"), F.col("broken")).otherwise(F.lit(0)).cast("bigint").alias("errors"),
    )


def stop_on_large_failures(outcomes: DataFrame) -> DataFrame:
    """Fail the job if a failed class is too large to be dropped."""
    problem = F.concat(F.lit("no message opens for tag "), F.hex("tag"), F.lit(" of threshold "), F.col("threshold"))
    checked = F.when(F.col("too_many"), F.raise_error(problem).cast("boolean")).otherwise(F.col("failed"))
    return outcomes.withColumn("failed", checked)


# -- rounds ------------------------------------------------------------------------------------------------------------


@dataclass
class SealedBatch:
    """Tables a run over one batch of sealed messages has written."""

    changes: DataFrame
    pending: DataFrame
    quarantine: DataFrame
    errors: int
    rounds: int


def in_parts(messages: DataFrame, total: int) -> list[DataFrame]:
    """``total`` messages in parts of at most PART_MESSAGES, but for buckets that hold more. Messages of an outer tag stay
    together."""
    if total <= PART_MESSAGES:
        return [messages]
    bucket = F.pmod(F.xxhash64(*_KEYS), F.lit(BUCKETS))
    sizes = messages.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most BUCKETS rows
    starts, held = [0], 0
    for row in sorted(sizes, key=lambda row: row.bucket):
        if held and held + row.n > PART_MESSAGES:
            starts.append(row.bucket)
            held = 0
        held += row.n
    return [messages.filter((bucket >= start) & (bucket < stop)) for start, stop in zip(starts, [*starts[1:], BUCKETS])]


def _together(spark: SparkSession, parts: list[DataFrame], schema: str) -> DataFrame:
    result = spark.createDataFrame([], schema)
    for part in parts:
        result = result.unionByName(part)
    return result


def process_batch(
    messages: DataFrame,
    recovered: DataFrame,
    pending: DataFrame,
    folder: str,
    total: int,
    max_failed: int = MAX_FAILED,
    max_failed_top: int = MAX_FAILED_TOP,
    salt: int = 0,
) -> SealedBatch:
    """Open a batch of sealed messages round by round, until a round opens nothing.

    ``recovered`` are the current state rows, ``pending`` all pending rows ever appended, ``total`` the number of new
    messages, ``folder`` a work folder that all executors share. Of the state only the batch's epochs are read. A class
    whose shares give no key goes on waiting; with another ``salt`` a later batch tries other shares.

    A large batch is opened in parts, one after the other, so that what is written at once does not grow with it. A tag
    stands for all layers above it, so a part with whole outer tags has all messages of its inner tags.

    ``messages`` are read twice for each part, once more if some go on waiting, and once for the sizes of the parts: only
    the fields without the inner layers, the bulk of a message, are written. A round's messages are deleted once the next
    ones are written.
    """
    spark = messages.sparkSession
    heavy = heavy_rows(total)
    with shuffles_dropped(spark):
        parts = in_parts(messages, total)
        done = [_process_part(part, recovered, pending, f"{folder}/part={at}", heavy, salt) for at, part in enumerate(parts)]
    return SealedBatch(
        _together(spark, [table for part in done for table in part.changes], state.RECOVERED_CHANGES),
        _together(spark, [table for part in done for table in part.pending], PENDING),
        _together(spark, [table for part in done for table in part.quarantine], QUARANTINE),
        sum(part.errors for part in done),
        max(len(part.changes) for part in done),
    )


@dataclass
class _Part:
    """Tables that the rounds of a part have written."""

    changes: list[DataFrame]
    pending: list[DataFrame]
    quarantine: list[DataFrame]
    errors: int


def _process_part(messages: DataFrame, recovered: DataFrame, pending: DataFrame, folder: str, heavy: int, salt: int) -> _Part:
    spark = messages.sparkSession

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    fields = ["epoch", "tag", "threshold", "msg_id", "x", "y", "ct", "inner"]
    no_parent = F.lit(None).cast("binary").alias("parent_tag")
    # Each round reads its messages several times, mostly a few columns of them; all columns only as it opens them.
    outer = [name for name in fields if name != "inner"]
    new, whole = written(messages.select(*outer), "parsed"), messages.select(*fields, no_parent)
    spent = f"{folder}/parsed"
    epochs = [row.epoch for row in new.select("epoch").distinct().collect()]  # at most 256
    recovered, pending = (rows.filter(F.col("epoch").isin(epochs)) for rows in (recovered, pending))
    lineage = spark.createDataFrame([], state.RECOVERED_CHANGES).select(*_KEYS, "path", "chain")
    changes, waits, quarantine = [], [], []
    errors = 0
    for number in count(1):
        if new.isEmpty():
            break
        where = f"round={number}"
        new_counts = new.groupBy(*_CLASS).agg(F.count(F.lit(1)).alias("n"))
        known = lookup_keys(new_counts, recovered)
        waiting = written(state.lookup_pending(new_counts, recovered, pending).select(*fields, no_parent), f"{where}/waiting")
        waiting_counts = waiting.groupBy(*_CLASS).agg(F.count(F.lit(1)).alias("n"))
        counts = written(
            new_counts.withColumn("is_new", F.lit(True)).unionByName(waiting_counts.withColumn("is_new", F.lit(False))),
            f"{where}/counts",
        )
        unknown = counts.join(known.select(*_KEYS), _KEYS, "left_anti")
        eligible = written(
            eligible_classes(
                unknown.filter("is_new").drop("is_new"), unknown.filter("NOT is_new").drop("is_new"), _KEYS
            ),
            f"{where}/eligible",
        )
        sent = [*_CLASS, "msg_id", "x", "y", "ct"]
        shares = spread_join(new.select(*sent).unionByName(waiting.select(*sent)), eligible, _CLASS, heavy, "msg_id")
        highest = eligible.agg(F.max("threshold")).first()[0] or 0
        fresh = tag_keys(tested_keys(share_sample(shares, salt, highest), f"{folder}/{where}/shares"))
        sizes = counts.groupBy(*_KEYS).agg(F.sum("n").alias("n"))
        keys = written(known.unionByName(fresh).join(sizes, _KEYS), f"{where}/keys")
        drop_folder(spark, f"{folder}/{where}/shares")
        if not counts.filter("is_new").join(keys, _KEYS, "left_anti").isEmpty():
            unopened = state.still_pending(without_heavy(whole.select(*fields), keys, _KEYS, heavy), keys)
            waits.append(written(unopened, f"{where}/pending"))
        if keys.isEmpty():
            break
        both = whole.unionByName(waiting)
        opened = written(open_layer(spread_join(both, keys, _KEYS, heavy, "msg_id")), f"{where}/opened")
        for read in (spent, f"{folder}/{where}/waiting"):
            drop_folder(spark, read)
        spent = f"{folder}/{where}/opened"
        outcomes = written(stop_on_large_failures(class_outcomes(opened)), f"{where}/outcomes")

        nodes = outcomes.filter("NOT failed").groupBy(*_KEYS).agg(
            F.sum("n").alias("change"),
            F.max("goes_on").alias("has_children"),
            F.min(F.struct("threshold", "name", "value")).alias("named"),
            F.min("parent_tag").alias("parent_tag"),
        )
        above = lineage.select("epoch", F.col("tag").alias("parent_tag"), F.col("path").alias("p"), F.col("chain").alias("c"))
        own = F.array(F.struct(F.col("named.name").alias("name"), F.col("named.value").alias("value")))
        rows = (
            nodes.join(above, ["epoch", "parent_tag"], "left")
            .join(keys.select(*_KEYS, "key"), _KEYS)
            .select(
                *_KEYS,
                "parent_tag",
                "named.name",
                "named.value",
                F.when(F.col("p").isNull(), F.array("tag")).otherwise(F.concat("p", F.array("tag"))).alias("path"),
                F.when(F.col("c").isNull(), own).otherwise(F.concat("c", own)).alias("chain"),
                "key",
                "change",
                "has_children",
            )
        )
        change = written(rows, f"{where}/changes")
        changes.append(change)
        # The parents of the next round's tags are the tags of this one.
        lineage = change.select(*_KEYS, "path", "chain")
        failed = outcomes.filter("failed").select(*_CLASS)
        none_failed = failed.isEmpty()
        if not none_failed:
            lost = opened.join(failed, _CLASS, "left_semi")
            quarantine.append(written(lost.select(*_CLASS, "msg_id"), f"{where}/lost"))
        errors += outcomes.agg(F.sum("errors")).first()[0] or 0
        # The next round reads its messages from what this one opened.
        new = whole = next_layer(opened, None if none_failed else failed)
    drop_folder(spark, spent)
    return _Part(changes, waits, quarantine, errors)


def lookup_keys(tags: DataFrame, recovered: DataFrame) -> DataFrame:
    """Keys that earlier runs recovered for the given tags."""
    return state.lookup_recovered(tags, recovered).select(*_KEYS, "key")
