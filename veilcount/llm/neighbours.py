"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by its own pseudo-rotation, three rounds of random signs and a fast Hadamard transform, and
puts them into the bucket of the nearest signed axis. A query probes, in every table, the buckets of the axes it is
nearest to. Vectors meet the queries that probe their bucket in one group; there the cosines are computed exactly, in
double precision, and only each query's best of the group leave it, so no candidate pair ever becomes a row. The best of
all groups are ranked once more.

Equal vectors are one entry with their few smallest ids before anything is dealt out, so copies cannot fill a bucket. A
bucket above `GROUP_ROWS` entries is dealt into several groups by a hash, and the queries that probe it go to each of them.
Queries that find too few neighbours are searched again over all buckets of one table, which is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilcount.session import new_work_folder

TABLES, PROBES = 4, 28
GROUP_ROWS = 20_000


def rotate(vectors: np.ndarray, table: int, size: int) -> np.ndarray:
    """The table's pseudo-rotation of rows with `size` columns, a power of two."""
    signs = np.random.default_rng([table, size]).choice([-1.0, 1.0], (3, size))
    turned = np.zeros((len(vectors), size))
    turned[:, : vectors.shape[1]] = vectors
    for row in signs:
        turned *= row
        step = 1
        while step < size:
            pairs = turned.reshape(len(turned), -1, 2, step)
            turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(turned), size)
            step *= 2
        turned /= np.sqrt(size)
    return turned


def nearest_axes(vectors: np.ndarray, table: int, count: int) -> np.ndarray:
    """The numbers of the `count` nearest signed axes of each row, nearest first; axis a is 2a, its opposite 2a + 1."""
    size = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    turned = rotate(vectors, table, size)
    signed = np.stack([turned, -turned], 2).reshape(len(turned), -1)
    if count == 1:
        return signed.argmax(1)[:, None]
    return np.argsort(-signed, axis=1, kind="stable")[:, :count]


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1) if vectors else np.zeros((0, 0))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, width and the components as doubles, without null ids and vectors that cannot take part."""
    plain = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return plain.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    ).withColumn("width", F.size("vector"))


def _entries(found: DataFrame, neighbours: int) -> DataFrame:
    """One row for each distinct vector, with its smallest ids: one more than are asked for, as a query may be among them."""
    ranked = Window.partitionBy("vector").orderBy("vec_id")
    few = found.dropDuplicates(["vec_id", "vector"]).withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= neighbours + 1)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("width").alias("width"))


_ROW = [
    T.StructField("width", T.IntegerType()),
    T.StructField("table", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("vector", T.BinaryType()),
]


def _dealt(frame: DataFrame, tables: int, probes: int) -> DataFrame:
    """A row for every table and probed bucket of each entry; 0 probes: all buckets."""

    def run(batches):
        for batch in batches:
            columns = {name: batch.column(at) for at, name in enumerate(batch.schema.names)}
            widths = np.asarray(columns["width"])
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                ids = columns["ids"].take(pa.array(at))
                flat = columns["vector"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                rows = flat.reshape(len(at), width).astype("<f8")
                units = rows / np.abs(rows).max(1, keepdims=True)
                units /= np.linalg.norm(units, axis=1, keepdims=True)
                packed = pa.array([row.tobytes() for row in rows], pa.binary())
                for table in range(tables):
                    axes = nearest_axes(units, table, probes or 1 << 30)
                    for probe in range(axes.shape[1]):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(at), width), pa.int32()),
                                pa.array(np.full(len(at), table), pa.int32()),
                                pa.array(axes[:, probe], pa.int32()),
                                ids,
                                packed,
                            ],
                            ["width", "table", "bucket", "ids", "vector"],
                        )

    return frame.select("width", "ids", "vector").mapInArrow(run, T.StructType(_ROW))


BEST = "query_id long, vec_id long, score double"


def _best_of_group(neighbours: int):
    def run(group: pa.Table) -> pa.Table:
        asked = np.asarray(group["query"])
        entries, queries = group.filter(pa.array(~asked)), group.filter(pa.array(asked))
        ids, query_ids = entries["ids"].to_pylist(), [row[0] for row in queries["ids"].to_pylist()]
        found: list[tuple] = []
        if ids and query_ids:
            rows, wanted = _matrix(entries["vector"].to_pylist()), _matrix(queries["vector"].to_pylist())
            rows, wanted = rows / np.abs(rows).max(1, keepdims=True), wanted / np.abs(wanted).max(1, keepdims=True)
            lengths = np.sqrt((rows * rows).sum(1))
            for start in range(0, len(wanted), 256):
                block = wanted[start : start + 256]
                block_lengths = np.sqrt((block * block).sum(1))
                near = block @ rows.T / lengths / block_lengths[:, None]
                # The query's own entry may be the best: one more is kept, and what rounding cannot tell apart from it.
                keep = min(neighbours + 1, len(ids))
                least = np.partition(near, len(ids) - keep, axis=1)[:, len(ids) - keep] - 1e-9
                for at, row in zip(*np.nonzero(near >= least[:, None])):
                    # Summed pair by pair, so that a pair has the same score in every group.
                    score = float((block[at] * rows[row]).sum() / (block_lengths[at] * lengths[row]))
                    own = query_ids[start + at]
                    found += [(own, vec_id, score) for vec_id in ids[row] if vec_id != own]
        found.sort(key=lambda hit: (hit[0], -hit[2], hit[1]))
        kept, count, last = [], 0, None
        for hit in found:
            count, last = (count + 1 if hit[0] == last else 1), hit[0]
            if count <= neighbours:
                kept.append(hit)
        columns = list(zip(*kept)) or [(), (), ()]
        return pa.table(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    return run


def _search(entries: DataFrame, queries: DataFrame, neighbours: int, tables: int, probes: int) -> DataFrame:
    spark = entries.sparkSession
    rows = _dealt(entries, tables, 1)
    # At most as many large buckets as tables times signed axes: a few hundred rows.
    sizes = rows.groupBy("width", "table", "bucket").count().where(F.col("count") > GROUP_ROWS)
    groups = [(r["width"], r["table"], r["bucket"], -(-r["count"] // GROUP_ROWS)) for r in sizes.collect()]
    parts = F.broadcast(spark.createDataFrame(groups, "width int, table int, bucket int, parts long"))
    on = ["width", "table", "bucket"]
    split = lambda frame: frame.join(parts, on, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    stored = split(rows).withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")))
    asked = split(_dealt(queries, tables, probes)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    kept = [*on, "part", "ids", "vector"]
    together = stored.select(*kept, F.lit(False).alias("query")).union(asked.select(*kept, F.lit(True).alias("query")))
    best = together.groupBy(*on, "part").applyInArrow(_best_of_group(neighbours), BEST)
    # A pair found in several tables has one score.
    return best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def _ranked(found: DataFrame, neighbours: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    neighbours: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest vectors found for each query, by cosine, ties to the smaller id.

    Null, zero and non-finite vectors, vectors with a null component and rows with a null id take no part; vectors are only
    compared with those of as many components. A row is named by its id: rows with the query's id are its own, repeated
    rows count once, and different vectors under one id keep the better score. Other columns are ignored. A query without
    any candidate has no row.
    """
    spark = vectors.sparkSession
    found = usable(vectors, id_column, vector_column)
    asked = usable(queries, id_column, vector_column).dropDuplicates(["vec_id", "vector"]).withColumn("ids", F.array("vec_id"))
    folder = new_work_folder(spark, "neighbours")
    _entries(found, neighbours).write.parquet(folder + "/entries")
    entries = spark.read.parquet(folder + "/entries")
    _ranked(_search(entries, asked, neighbours, tables, probes), neighbours).write.parquet(folder + "/found")
    first = spark.read.parquet(folder + "/found")
    full = first.where(F.col("rank") == neighbours).select(F.col("query_id").alias("vec_id"))
    short = asked.join(full, "vec_id", "left_anti")
    if short.isEmpty():
        return first
    again = _search(entries, short, neighbours, 1, 0)
    return _ranked(first.select("query_id", "vec_id", "score").unionByName(again).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), neighbours)


def report(embeddings: DataFrame) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50, among all others."""
    return nearest(embeddings, embeddings.where(F.col("vec_id") % 50 == 0))
