"""A corpus from raw documents to shuffled shards, in stages that run alone or in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linetrace.llm.decontaminate import decontaminated
from linetrace.llm.mixing import mixed_documents
from linetrace.llm.quality import quality_filter
from linetrace.llm.sharding import shuffled_shards
from linetrace.llm.simhash import without_near_duplicates
from linetrace.session import checkpointed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in their shards and slots; the slot orders a shard.

    Whole texts are sorted, so the unit of sorting has fewer rows than for slim ones.
    """
    return shuffled_shards(docs, part_rows=1 << 15).select("row.*", "shard", "slot")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixing", mixing),
    ("sharding", sharding),
]
#: The stages have no SQL form (SimHash components); tests hold them against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
