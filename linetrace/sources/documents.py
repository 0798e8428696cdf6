"""Version pairs found in a table of documents or of conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linetrace.functions.text import text_key
from linetrace.session import checkpointed, numbered

# Rows of one group are ordered inside buckets of this many consecutive numbers,
# so a group holding a third of the table is still spread over many tasks.
BUCKET = 1 << 16


def chain_neighbours(
    rows: DataFrame, group: list[str], order: str, bucket: int = BUCKET
) -> DataFrame:
    """Add ``previous`` and ``following``: the neighbours of ``order`` in its group.

    Same as ``lag`` and ``lead`` over the whole group. Inside a bucket they are
    windows; over bucket borders they come from a table with one row per bucket.
    """
    bucketed = rows.withColumn("bucket", F.floor(F.col(order) / bucket).cast("bigint"))
    inside = Window.partitionBy(*group, "bucket").orderBy(order)
    across = Window.partitionBy(*group).orderBy("bucket")
    borders = (
        bucketed.groupBy(*group, "bucket")
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
        .select(
            *group,
            "bucket",
            F.lag("last").over(across).alias("before"),
            F.lead("first").over(across).alias("after"),
        )
        .where("before is not null or after is not null")
    )
    return (
        bucketed.withColumn("previous", F.lag(order).over(inside))
        .withColumn("following", F.lead(order).over(inside))
        .join(borders, [*group, "bucket"], "left")
        .withColumn("previous", F.coalesce("previous", "before"))
        .withColumn("following", F.coalesce("following", "after"))
        .drop("bucket", "before", "after")
    )


def _versions(chained: DataFrame, own: F.Column, next_: F.Column) -> DataFrame:
    """Each text is the new side of its own pair and the old side of the next one."""
    roles = F.array(
        F.when(
            F.col("previous").isNotNull(),
            F.struct(own.cast("string").alias("pair_id"), F.lit("new").alias("side")),
        ),
        F.when(
            F.col("following").isNotNull(),
            F.struct(next_.cast("string").alias("pair_id"), F.lit("old").alias("side")),
        ),
    )
    return chained.select(F.explode(F.array_compact(roles)).alias("role"), "text").select(
        "role.pair_id", "role.side", "text"
    )


def _one_text_each(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: of an id on several rows the text that is first in order; no null."""
    texts = documents.where("text is not null and doc_id is not null").select("doc_id", "text")
    several = checkpointed(texts.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if several.isEmpty():
        return texts
    first = texts.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return texts.join(several, "doc_id", "left_anti").unionByName(first)


def pair_votes(documents: DataFrame) -> DataFrame:
    """``doc_id, old_id, votes``: lines whose last earlier holder is document ``old_id``.

    Every non-blank line of a document counts once; lines meet by the key of the whole text. Documents are
    ordered by id; ids that are no whole numbers get one, their place in the order.
    Of an id on several rows the first text counts, so no document precedes itself.
    """
    texts = _one_text_each(documents)
    whole = isinstance(texts.schema["doc_id"].dataType, T.IntegralType)
    held = texts.select("doc_id", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).where(
        F.col("line").rlike(r"[^\x09-\x0D\x20]")
    )
    held = held.withColumn("line", text_key(F.col("line")))
    if whole:
        chained = chain_neighbours(held, ["line"], "doc_id").where("previous is not null")
        return chained.groupBy("doc_id", F.col("previous").alias("old_id")).agg(F.count("*").alias("votes"))
    names = checkpointed(numbered(texts.select("doc_id"), "place", "doc_id"))
    placed = held.join(names, "doc_id").select("place", "line")
    chained = chain_neighbours(placed, ["line"], "place").where("previous is not null")
    votes = chained.groupBy("place", "previous").agg(F.count("*").alias("votes"))
    old = names.select(F.col("place").alias("previous"), F.col("doc_id").alias("old_id"))
    return votes.join(names, "place").join(old, "previous").select("doc_id", "old_id", "votes")


def version_pairs(documents: DataFrame) -> DataFrame:
    """``doc_id, old_id``: the earlier document with most votes, the largest id if several."""
    best = F.max(F.struct("votes", "old_id")).alias("best")
    return pair_votes(documents).groupBy("doc_id").agg(best).select("doc_id", "best.old_id")


def document_versions(documents: DataFrame) -> DataFrame:
    """New version = a document, old version = the earlier one it shares most lines with.

    A document without an earlier holder of one of its lines is no new version. Ids may be of
    any ordered type; of an id on several rows the text that is first in order counts.
    """
    pairs = checkpointed(version_pairs(documents))
    texts = _one_text_each(documents)
    name = F.col("doc_id").cast("string").alias("pair_id")
    new = pairs.select("doc_id", name, F.lit("new").alias("side"))
    old = pairs.select(F.col("old_id").alias("doc_id"), name, F.lit("old").alias("side"))
    return texts.join(new.unionByName(old), "doc_id").select("pair_id", "side", "text")


def conversation_versions(conversations: DataFrame) -> DataFrame:
    """New version = a turn, old version = the turn before it of the same role."""
    turns = conversations.where("text is not null").select("conv_id", "role", "turn", "text")
    chained = chain_neighbours(turns, ["conv_id", "role"], "turn")
    name = lambda turn: F.concat_ws(":", F.col("conv_id"), F.col("role"), turn)
    return _versions(chained, name(F.col("turn")), name(F.col("following")))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
