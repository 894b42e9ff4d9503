"""Merkle manifest of a dataset: leaf digests, subtree roots by language, one root, and the siblings that prove each leaf.

Leaves are numbered within their tree in parallel: they are dealt by ranges of the key, and each range's first number comes
from the sizes of the ranges before it. Aligned blocks of `BLOCK` consecutive nodes hold a level of the tree as one string of
hexadecimal digests, joined without separators. The inputs of a parent are then a fixed-width substring of its level, so
SQL's `substring` and `sha2` make the next level; a short last run needs no case of its own. The last string of a block is
one digest, a node of the tree above, which is cut into blocks in the same way until one digest is left. The roots of
the trees are the leaves of a last tree.

On the way back every block looks up the siblings of its own root, and a leaf's siblings are the substrings beside its
place, followed by those of its block. A block is bounded, so a tree of any size is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilcount.session import new_work_folder

#: Children of a node, levels in a block, and so nodes of a block.
ARITY, LEVELS = 2, 10
BLOCK = ARITY**LEVELS
#: Hexadecimal characters of a digest.
WIDTH = 64

SIBLINGS = "array<struct<before string, after string>>"


def digest(*parts) -> Column:
    """Lowercase hexadecimal sha256 of the parts, joined."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A leaf's field: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def number_nodes(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` (with tree, node) with `place`, from 0 within its tree in the order of `order`, and the tree's `total`.

    The rows are written in key order; each range of rows looks up where it starts in its tree. Rows that agree in `order`
    and node take neighbouring places in any order; a running number spreads them over ranges.
    """
    spark = nodes.sparkSession
    work = new_work_folder(spark, "manifest-order")
    keys = ["tree", *order, "node", "spread"]
    nodes.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(
        "spread"
    ).withColumn("row_place", F.monotonically_increasing_id()).write.parquet(work)
    written = spark.read.parquet(work).withColumn("part", F.shiftright("row_place", 33))
    runs = written.groupBy("tree", "part").agg(F.min("row_place").alias("first"), F.count("*").alias("rows"))
    runs = runs.selectExpr(
        "tree AS run_tree",
        "part AS run_part",
        "first",
        "sum(rows) OVER (PARTITION BY tree ORDER BY part) - rows AS start",  # one row for each range of the tree
        "sum(rows) OVER (PARTITION BY tree) AS total",
    )
    same = (F.col("part") == F.col("run_part")) & F.col("tree").eqNullSafe(F.col("run_tree"))
    numbered = written.join(runs, same).withColumn("place", F.col("start") + F.col("row_place") - F.col("first"))
    return numbered.select(*nodes.columns, "place", "total")


def _levels(bottom: str, more: str) -> str:
    """SQL for the levels of a block from its lowest up, each one binary string of hexadecimal digests."""
    inputs = f"substring(element_at(levels, -1), run * {ARITY * WIDTH} + 1, {ARITY * WIDTH})"
    runs = f"sequence(0, cast((length(element_at(levels, -1)) - 1) div {ARITY * WIDTH} as int))"
    parents = f"cast(array_join(transform({runs}, run -> sha2({inputs}, 256)), '') as binary)"
    start = f"array(cast({bottom} as binary))"
    step = f"IF(length(element_at(levels, -1)) > {WIDTH} OR {more}, concat(levels, array({parents})), levels)"
    return f"aggregate(sequence(1, {LEVELS}), {start}, (levels, level) -> {step})"


def _beside(place: str) -> str:
    """SQL for the siblings of a place of a block at each level that has one above it."""
    node = f"({place} div cast(power({ARITY}, level) as int))"
    run = f"({node} div {ARITY} * {ARITY})"
    cut = "cast(substring(levels[level], {} * %d + 1, ({}) * %d) as string)" % (WIDTH, WIDTH)
    before = cut.format(run, f"{node} - {run}")
    after = cut.format(f"({node} + 1)", f"{run} + {ARITY} - {node} - 1")
    height = "size(levels) - 2"
    made = f"transform(sequence(0, {height}), level -> struct({before} AS before, {after} AS after))"
    return f"IF({height} < 0, CAST(array() AS {SIBLINGS}), {made})"


def _itself(tops: DataFrame) -> DataFrame:
    """The top of each tree is its root."""
    return tops.select("tree", "subroot", F.col("subroot").alias("root"), F.array().cast(SIBLINGS).alias("above"))


def _below_one_root(tops: DataFrame) -> DataFrame:
    """The tops of all trees are the leaves of one more tree, in the order of the trees' names."""
    kept = F.struct(F.col("tree").alias("name"), "subroot").alias("kept")
    named = tops.select(F.lit(None).cast("string").alias("tree"), F.col("subroot").alias("node"), kept, F.col("tree").alias("name"))
    grown = grow(number_nodes(named, ["name"]).drop("name"), "kept")
    return grown.select(F.col("kept.name").alias("tree"), "kept.subroot", "root", F.col("siblings").alias("above"))


def grow(nodes: DataFrame, carried: str, crown=_itself) -> DataFrame:
    """Roots and siblings of numbered nodes: tree, place, total, node, and a struct named by `carried`.

    Gives tree, place, `carried`, subroot (the tree's top), root and siblings: for each level up to the root what stands
    before and after the node in its run, as digests without separators; both are empty for a node that is hashed alone.
    crown: from tree and subroot, one row for each tree, to tree, subroot, root and the siblings above the subroot.
    """
    spark = nodes.sparkSession
    work = new_work_folder(spark, "manifest-blocks")
    item = F.struct((F.col("place") % BLOCK).cast("int").alias("at"), "node", F.col(carried).alias("kept"))
    block = F.expr(f"place div {BLOCK}").alias("block")
    gathered = nodes.groupBy("tree", "total", block).agg(F.sort_array(F.collect_list(item)).alias("items"))  # at most BLOCK
    gathered = gathered.withColumn("levels", F.expr(_levels("array_join(items.node, '')", f"total > {BLOCK}")))
    gathered.write.parquet(work)
    blocks = spark.read.parquet(work)
    top = F.element_at("levels", -1).cast("string")
    if blocks.where(F.col("total") > BLOCK).isEmpty():  # one block a tree
        upper = crown(blocks.select("tree", top.alias("subroot"))).withColumn("place", F.lit(0).cast("long"))
    else:
        # A tree that is one block already goes through the rounds of larger ones as it is.
        total = F.expr(f"(total + {BLOCK} - 1) div {BLOCK}").alias("total")
        upper = blocks.select("tree", F.col("block").alias("place"), total, top.alias("node"), F.struct("block").alias("kept"))
        upper = grow(upper, "kept", crown).withColumnRenamed("siblings", "above")
    upper = upper.select(F.col("tree").alias("of"), F.col("place").alias("at_place"), "subroot", "root", "above")
    placed = blocks.join(upper, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at_place")))
    rows = F.expr(f"transform(items, x -> struct(x.at AS at, x.kept AS kept, concat({_beside('x.at')}, above) AS siblings))")
    opened = placed.select("tree", "block", "subroot", "root", F.explode(rows).alias("x"))
    place = (F.col("block") * BLOCK + F.col("x.at")).alias("place")
    return opened.select("tree", place, F.col("x.kept").alias(carried), "subroot", "root", "x.siblings")


def fold(leaf: str, siblings: str = "siblings") -> Column:
    """The root that a leaf and its siblings give."""
    step = "(node, s) -> sha2(cast(concat(s.before, node, s.after) as binary), 256)"
    return F.expr(f"aggregate({siblings}, {leaf}, {step})")


def build(rows: DataFrame, tree: str, order: list[str], leaf: Column, keep: list[str]) -> DataFrame:
    """The manifest of `rows`: the columns `keep`, leaf, subroot, root and siblings up to the root.

    One tree for each value of the column `tree`, null included, its leaves ascending by `order`, nulls first, then by leaf.
    Trees stand below the root in the order of their values, null first, bytewise. No rows, no manifest.
    """
    spark = rows.sparkSession
    work = new_work_folder(spark, "manifest")
    kept = F.struct(*(rows[name] for name in keep), *(F.col(name).alias(f"order{at}") for at, name in enumerate(order)))
    # The texts are read once, here; what follows moves digests and the kept columns.
    leaves = rows.select(F.col(tree).cast("string").alias("tree"), leaf.alias("node"), kept.alias("kept"))
    leaves.write.parquet(f"{work}/leaves")
    leaves = spark.read.parquet(f"{work}/leaves")
    named = [f"order{at}" for at in range(len(order))]
    numbered = number_nodes(leaves.select("*", *(F.col(f"kept.{name}").alias(name) for name in named)), named)
    numbered = numbered.withColumn("kept", F.struct(F.col("node").alias("leaf"), "kept"))
    grown = grow(numbered.select("tree", "place", "total", "node", "kept"), "kept", _below_one_root)
    return grown.select(
        *(F.col(f"kept.kept.{name}").alias(name) for name in keep), F.col("kept.leaf").alias("leaf"), "subroot", "root", "siblings"
    )


def document_leaf(n_chars: str = "n_chars") -> Column:
    return digest(*(field(F.col(name)) for name in ("doc_id", "source", "lang", n_chars, "text")))


def report(documents: DataFrame) -> DataFrame:
    """Each document's leaf, roots, proof digest, and whether the tampered leaf still gives the root.

    A null doc_id is no number, so its row is not tampered with; such rows stand first in their tree. Repeated rows are
    leaves of their own; those equal in doc_id stand in the order of their leaves. Null and empty texts differ.
    """
    documents = documents.select("doc_id", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = documents.withColumn("more_chars", F.col("n_chars") + 1)
    changed = F.when(chosen, document_leaf("more_chars"))
    made = build(more.withColumn("changed", changed), "lang", ["doc_id"], document_leaf(), ["doc_id", "changed"])
    joined = "array_join(transform(siblings, s -> concat(s.before, s.after)), '')"
    folded = made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.expr(joined).cast("binary"), 256).alias("proof_sha256"),
        fold("coalesce(changed, leaf)").alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
