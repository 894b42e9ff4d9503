"""A corpus pipeline of five stages, each calling one operator of `veilcount.llm` on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir) to a DataFrame. `run` applies them to the documents, each stage written
as Parquet in the shared folder and read again, so a lost executor costs the tasks of one stage only. All but the last
return the columns of documents.

1. toxicity: rows that the classifier rejects go; it learns from the rows of `labels` that are not held out.
2. near_duplicates: of each component of similar texts one document stays.
3. decontaminate: documents that hold a window of the benchmark go.
4. mix_sources: every document stays at least once; documents of sources that weigh more than their tokens are repeated,
   up to the repetition limit.
5. shard: every row gets a shard and a slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilcount.llm import decontaminate, mixing, ngram_join, shards, toxicity
from veilcount.session import new_work_folder

SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels of rows that an earlier step dropped teach nothing; without labels of both classes nothing is rejected."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit_on(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without words or without doc_id all stay."""
    return ngram_join.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Uses of one document have equal keys; they take neighbouring row numbers and so distant shards."""
    return shards.assign_shards(docs, ["doc_id", "source", "text"], SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: A compressor's output lengths decide the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    folder = new_work_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
