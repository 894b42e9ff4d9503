"""Mixing sources to target weights: temperature, with built-in functions only.

Shares of tokens per source are raised to an exponent and normalised. The exponent is found by bisection, as the smallest
in [0, 1] whose weights meet the target: no source is repeated more than `limit` times as often as the least repeated, or
the weights' entropy is at most the one asked for. The budget is the smallest with which every source is used in full at
least once, or the caller's. A source's budget is realised as whole epochs and a rest: each epoch is a permutation of the
source's documents, in blocks dealt by a hash; the rest takes whole blocks of the last permutation while they fit, and
from the first block that does not, documents in the permutation's order while they fit.

Only counts per source and block are shuffled: sums, combined before the shuffle, whatever a source's share of the rows.
Just the one cut block of each source is put in order; a source has so many blocks that each is a small share of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilcount.session import new_work_folder

STEPS = 60
#: Documents that a block holds on average, and the most blocks a source is dealt into.
BLOCK_ROWS, MOST_BLOCKS = 256, 65_536
#: Most sources that are broadcast, a hundred bytes each.
MOST_SENT = 100_000
REPETITION_LIMIT = 2.0
WORD = r"[^\x20\x09-\x0D]+"


def measured(documents: DataFrame, seed: str) -> DataFrame:
    """`row`, all columns of `documents` as one struct, with `source` (null: empty), `n_tokens` (blank-separated words)
    and `name`, which tells rows apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return documents.select(
        F.struct(*(documents[column] for column in documents.columns)).alias("row"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_tokens"),
        F.concat_ws("|", F.lit(seed), doc_id, F.md5(text)).alias("name"),
    )


def _dealt(epoch: Column) -> Column:
    """Hash of a row in an epoch, as 12 hexadecimal digits."""
    return F.substring(F.md5(F.concat_ws("|", "name", epoch.cast("string"))), 1, 12)


def _block(dealt: Column, blocks: Column) -> Column:
    return F.conv(dealt, 16, 10).cast("bigint") % blocks


def _powers(exponent: Column) -> Column:
    return F.transform("shares", lambda share: F.pow(share, exponent))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _spread(exponent: Column) -> Column:
    """How many times as often the most repeated source is repeated as the least: shares of weight by shares of tokens."""
    ratios = F.transform("shares", lambda share: F.pow(share, exponent) / share)
    return F.array_max(ratios) / F.array_min(ratios)


def _entropy(exponent: Column) -> Column:
    powers = _powers(exponent)
    total = _sum(powers)
    return -_sum(F.transform(powers, lambda power: power / total * F.ln(power / total)))


def plan(totals: DataFrame, limit: float | None = REPETITION_LIMIT, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """source, tokens, rows, weight, epochs, rest and blocks; totals: source, tokens and rows of every source.

    One row holds all sources' shares while the exponent is bisected: a double for each source. Sources without tokens
    weigh nothing and are used once. Give either a repetition limit or an entropy (in nats).
    """
    goal, target = (_entropy, entropy) if entropy is not None else (_spread, limit)
    used = totals.where(F.col("tokens") > 0)
    tokens = F.array_sort(F.collect_list("tokens"))
    one = used.agg(tokens.alias("tokens"), F.sum("tokens").alias("total")).withColumn(
        "shares", F.transform("tokens", lambda count: count / F.col("total"))
    )

    def halve(bounds: Column, _: Column) -> Column:
        middle = (bounds["low"] + bounds["high"]) / 2
        enough = goal(middle) <= target
        return F.struct(
            F.when(enough, bounds["low"]).otherwise(middle).alias("low"), F.when(enough, middle).otherwise(bounds["high"]).alias("high")
        )

    bounds = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), halve)
    exponent = F.when(goal(F.lit(0.0)) <= target, F.lit(0.0)).otherwise(F.round(bounds["high"], 6))
    solved = one.withColumn("exponent", exponent).withColumn("powers", _sum(_powers(F.col("exponent"))))
    # Tokens of the whole mix: with the least repeated source used once, or as asked for.
    scale = F.array_max(F.transform("shares", lambda share: share * F.col("powers") / F.pow(share, F.col("exponent"))))
    whole = F.lit(float(budget)) if budget is not None else scale * F.col("total")
    solved = solved.select("exponent", "powers", "total", whole.alias("whole"))
    share = F.col("tokens") / F.col("total")
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.col("exponent")) / F.col("powers")).otherwise(0.0)
    times = F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.col("whole") / F.col("tokens"), 6)).otherwise(1.0)
    return (
        totals.join(F.broadcast(solved), how="left")  # one row beside the sources
        .withColumn("weight", weight)
        .withColumn("times", times)
        .withColumn("epochs", F.floor("times"))
        .withColumn("rest", F.floor(F.round((F.col("times") - F.col("epochs")) * F.col("tokens"), 3)))
        .withColumn("blocks", F.least(F.ceil(F.col("rows") / BLOCK_ROWS), F.lit(MOST_BLOCKS)))
        .select("source", "tokens", "rows", F.round("weight", 9).alias("weight"), "epochs", "rest", "blocks")
    )


def _with_sources(frame: DataFrame, sources: DataFrame) -> DataFrame:
    """Joins a written table of sources; it is sent around only when its rows are counted to be few."""
    return frame.join(F.broadcast(sources) if sources.count() <= MOST_SENT else sources, "source")


def mix(
    documents: DataFrame,
    limit: float | None = REPETITION_LIMIT,
    entropy: float | None = None,
    budget: int | None = None,
    seed: str = "mix",
) -> DataFrame:
    """The mix: `row`, all columns of a row of `documents` as one struct, as often as its source's budget takes it, with
    source, n_tokens, name, weight, epoch (from 0) and block (place of its block in the epoch's permutation).

    A null source is a source of its own, called ''. Null and empty texts have no tokens: they are in every whole epoch,
    and in the rest where their block is. Repeated rows are mixed each; equal ones share their place, and may be cut from
    the rest in any order. Without rows the mix is empty.
    """
    rows = measured(documents, seed)
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    spark, folder = documents.sparkSession, new_work_folder(documents.sparkSession, "mixing")
    plan(totals, limit, entropy, budget).write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    # Tokens of every block of the last, cut epoch, and the first block that does not fit whole.
    last = _with_sources(rows.select("source", "n_tokens", "name"), sources)
    last = last.withColumn("block", _block(_dealt(F.col("epochs")), F.col("blocks")))
    sums = last.groupBy("source", "block").agg(F.sum("n_tokens").alias("held"), F.first("rest").alias("rest"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sums.withColumn("upto", F.sum("held").over(before))
    cuts = running.where(F.col("upto") > F.col("rest")).groupBy("source").agg(
        F.min("block").alias("cut"), F.min_by(F.col("rest") - (F.col("upto") - F.col("held")), "block").alias("room")
    )
    budgets = sources.join(cuts, "source", "left").withColumn("cut", F.coalesce("cut", F.col("blocks")))
    budgets.write.parquet(f"{folder}/budgets")

    dealt = _with_sources(rows, spark.read.parquet(f"{folder}/budgets"))
    final = dealt.withColumn("dealt", _dealt(F.col("epochs"))).withColumn("last", _block(F.col("dealt"), F.col("blocks")))
    whole = F.col("epochs") + F.when((F.col("rest") > 0) & (F.col("last") < F.col("cut")), 1).otherwise(0)
    times = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1))
    full = final.withColumn("times", whole.cast("bigint")).where(F.col("times") > 0).withColumn("epoch", times).drop("times")
    edge = final.where((F.col("rest") > 0) & (F.col("last") == F.col("cut")))
    order = Window.partitionBy("source").orderBy("dealt", "name").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = edge.withColumn("upto", F.sum("n_tokens").over(order)).where(F.col("upto") <= F.col("room"))
    together = full.unionByName(part.drop("upto").withColumn("epoch", F.col("epochs")))
    block = F.when(F.col("epoch") == F.col("epochs"), F.col("last")).otherwise(_block(_dealt(F.col("epoch")), F.col("blocks")))
    return together.withColumn("block", block).select(
        *rows.columns, "weight", F.col("epoch").cast("bigint").alias("epoch"), F.col("block").cast("bigint").alias("block")
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The mix with the columns of `documents` only."""
    return mix(documents, **options).select("row.*")


def report(documents: DataFrame) -> DataFrame:
    """Every use of a document in the mix, with its source's weight and its place."""
    found = mix(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "source",
        "n_tokens",
        "weight",
        "epoch",
        "block",
        F.substring(F.md5(F.concat_ws("|", "name", F.col("epoch").cast("string"))), 1, 12).alias("place"),
    )


#: The same rows in DuckDB's SQL: the bisection is a recursion over one row, `h` the hash of a row in an epoch.
ORACLE = rf"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
         'mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) AS name
  FROM documents),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS n FROM rows GROUP BY source),
one AS (SELECT list_sort(list(tokens / total::DOUBLE)) AS shares, any_value(total) AS total
        FROM totals, (SELECT sum(tokens)::BIGINT AS total FROM totals) WHERE tokens > 0),
halve AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, shares, total FROM one
  UNION ALL
  SELECT step + 1, CASE WHEN enough THEN low ELSE (low + high) / 2 END, CASE WHEN enough THEN (low + high) / 2 ELSE high END,
         shares, total
  FROM (SELECT *, list_max(list_transform(shares, lambda s: pow(s, (low + high) / 2) / s))
                / list_min(list_transform(shares, lambda s: pow(s, (low + high) / 2) / s)) <= {REPETITION_LIMIT} AS enough
        FROM halve WHERE step < {STEPS})),
solved AS (
  SELECT CASE WHEN list_max(list_transform(shares, lambda s: 1 / s)) / list_min(list_transform(shares, lambda s: 1 / s)) <= {REPETITION_LIMIT}
              THEN 0.0 ELSE round(high, 6) END AS exponent, shares, total FROM halve WHERE step = {STEPS}),
weighed AS (SELECT exponent, shares, total, list_sum(list_transform(shares, lambda s: pow(s, exponent))) AS powers FROM solved),
budget AS (SELECT *, list_max(list_transform(shares, lambda s: s * powers / pow(s, exponent))) * total AS whole FROM weighed),
planned AS (
  SELECT source, tokens, n, CASE WHEN tokens > 0 THEN pow(tokens / total::DOUBLE, exponent) / powers ELSE 0.0 END AS weight,
         CASE WHEN tokens > 0 THEN round(pow(tokens / total::DOUBLE, exponent) / powers * whole / tokens, 6) ELSE 1.0 END AS times
  FROM totals LEFT JOIN budget ON true),
sources AS (
  SELECT source, tokens, round(weight, 9) AS weight, floor(times)::BIGINT AS epochs,
         floor(round((times - floor(times)) * tokens, 3))::BIGINT AS rest,
         least(ceil(n / {BLOCK_ROWS}.0), {MOST_BLOCKS})::BIGINT AS blocks
  FROM planned),
final AS (
  SELECT r.*, s.weight, s.epochs, s.rest, s.blocks, substr(md5(name || '|' || epochs), 1, 12) AS h,
         ('0x' || substr(md5(name || '|' || epochs), 1, 12))::BIGINT % blocks AS block
  FROM rows r JOIN sources s USING (source)),
running AS (
  SELECT source, block, rest, held, sum(held) OVER (PARTITION BY source ORDER BY block) AS upto
  FROM (SELECT source, block, any_value(rest) AS rest, sum(n_tokens) AS held FROM final GROUP BY ALL)),
cuts AS (SELECT source, min(block) AS cut, min_by(rest - (upto - held), block) AS room FROM running WHERE upto > rest GROUP BY source),
edged AS (
  SELECT f.*, coalesce(cut, blocks) AS cut, room,
         sum(n_tokens) OVER (PARTITION BY f.source, f.block = coalesce(cut, blocks) ORDER BY h, name ROWS UNBOUNDED PRECEDING) AS upto
  FROM final f LEFT JOIN cuts USING (source)),
uses AS (
  SELECT *, unnest(range(0, epochs + CASE WHEN rest > 0 AND (block < cut OR (block = cut AND upto <= room)) THEN 1 ELSE 0 END)) AS epoch
  FROM edged)
SELECT doc_id, source, n_tokens, weight, epoch,
       ('0x' || substr(md5(name || '|' || epoch), 1, 12))::BIGINT % blocks AS block, substr(md5(name || '|' || epoch), 1, 12) AS place
FROM uses
"""
