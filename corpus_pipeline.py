"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing and sharding, one after the other.

Every stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as the next
stage's docs, so a stage works on all that the one before it kept, and a lost executor costs no earlier stage. All but
the last return the columns of ``documents``; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import line_rules, mixing, pivots, sharding, winnowing
from tidewatch.session import new_table_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines and rejected documents go."""
    return line_rules.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return pivots.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    return winnowing.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes."""
    return mixing.taken(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with the name, depth and bytes of its shard."""
    out = sharding.sharded(docs)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "depth", "shard_bytes")]
    return out.select(*own, F.col("shard.name").alias("shard"), F.col("shard.depth").alias("depth"), F.col("shard.shard_bytes").alias("shard_bytes"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: SimHash needs XXH64, which the check engine has not; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
