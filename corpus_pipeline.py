"""The corpus pipeline: five stages of the training-data operators over the documents table.

Each stage is written as Parquet and reread as the input of the next one, so a lost executor costs at most
the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.llm import decontaminate, mixing, neardup, shards, toxicity
from areacast.sources.tables import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), "doc_id", "toxic")
    return toxicity.score(docs.select(*COLUMNS), model).where("score < 0.5").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    marked = written(neardup.near_duplicates(docs, "doc_id", n=5, percent=80), "classes")
    ids = marked.where("kept").groupBy(F.col("doc_id").alias("kept_id"), "text_hash").agg(
        F.count("*").alias("rows")
    )
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("text_hash"))
    found = docs.select(*COLUMNS).join(ids, same)
    if not ids.where("rows > 1").isEmpty():
        # Repeated rows: those that share an id are cut down to one of each kind.
        again = found.where("rows > 1").select(*COLUMNS).dropDuplicates()
        found = found.where("rows = 1").select(*COLUMNS).unionByName(again)
    return found.select(*COLUMNS)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item.

    Each row is judged by its own text, also where ids are null or repeated.
    """
    found = decontaminate.contamination(
        docs, "doc_id", _table(spark, sf_dir, "benchmark"), "item_id", slop=0
    )
    hit = found.where(F.size("spans") > 0).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.xxhash64("text") == F.col("hit_hash"))
    clean = docs.join(hit, same, "left_anti")
    return clean.select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources take it."""
    return mixing.taken(docs.select(*COLUMNS), "doc_id")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in shuffled order over eight shards."""
    placed = shards.shuffled(docs.select(*COLUMNS), "doc_id", shards=8)
    return placed.withColumnsRenamed({"_shard": "shard", "_slot": "slot"})


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", not_in_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned weights, hash families and shuffles are no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
