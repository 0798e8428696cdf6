"""Line splits and merges next to one-to-one matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetrace.functions.text import bag_cosine
from linetrace.operators.candidates import bounded_text, combined, side_features, structure_similarity
from linetrace.operators.context import context_bags
from linetrace.session import checkpointed, keep_where

TEXTS = ["line_no", "pre", "struct_str"]


def _scored(pairs: DataFrame, texts: DataFrame, contexts: DataFrame, threshold: float) -> DataFrame:
    """Score ``pair_id, old_line, new_line`` rows, keep those reaching ``threshold``.

    Text and structure come first and drop nearly all rows; only the lines of the
    others need their context, the widest feature.
    """
    measured = (
        pairs.join(side_features(texts, "old", TEXTS), ["pair_id", "old_line"])
        .join(side_features(texts, "new", TEXTS), ["pair_id", "new_line"])
        .withColumn("s", structure_similarity())
        .withColumn("t", bounded_text(threshold, F.col("s"), F.lit(1.0)))
        .select(*pairs.columns, "t", "s")
    )
    close = checkpointed(keep_where(measured, F.col("t").isNotNull()))

    def bags(side: str) -> DataFrame:
        wanted = close.select("pair_id", F.col(f"{side}_line").alias("line_no")).distinct()
        own = contexts.where(F.col("side") == side).join(wanted, ["pair_id", "line_no"], "left_semi")
        return side_features(context_bags(own), side, ["line_no", "bag", "norm"])

    context = bag_cosine(F.col("old_bag"), F.col("new_bag"), F.col("old_norm"), F.col("new_norm"))
    scored = (
        close.join(bags("old"), ["pair_id", "old_line"])
        .join(bags("new"), ["pair_id", "new_line"])
        .select(*pairs.columns, combined(F.col("t"), F.col("s"), context).alias("score"))
    )
    return keep_where(scored, F.col("score") >= threshold)


def split_edges(primary: DataFrame, texts: DataFrame, contexts: DataFrame, threshold: float) -> DataFrame:
    """New lines next to the match of an old line that resemble the old line too.

    ``primary`` is one-to-one over non-blank lines. New lines already used elsewhere
    may be taken again.
    """
    beside = primary.select(
        "pair_id",
        "old_line",
        F.explode(F.array(F.col("new_line") - 1, F.col("new_line") + 1)).alias("new_line"),
    )
    return _scored(beside, texts, contexts, threshold)


def merge_edges(mapped: DataFrame, texts: DataFrame, contexts: DataFrame, threshold: float) -> DataFrame:
    """Unmapped old lines that join the target of a mapped neighbour.

    ``mapped`` holds all edges so far. In every run of unmapped non-blank lines the
    first lines follow the smallest target of the line before the run as long as
    each of them reaches ``threshold``; then the last line, if still free, may take
    the smallest target of the line after the run.
    """
    targets = mapped.groupBy("pair_id", "old_line").agg(F.min("new_line").alias("new_line"))
    by_line = Window.partitionBy("pair_id").orderBy("old_line")
    free = (
        texts.where("side = 'old'")
        .select("pair_id", F.col("line_no").alias("old_line"))
        .join(targets, ["pair_id", "old_line"], "left_anti")
        .withColumn("run", F.col("old_line") - F.row_number().over(by_line))
    )
    in_run = Window.partitionBy("pair_id", "run")
    free = free.withColumn("first", F.min("old_line").over(in_run)).withColumn(
        "last", F.max("old_line").over(in_run)
    )

    def offered(rows: DataFrame, neighbour: Column) -> DataFrame:
        return rows.withColumn("neighbour", neighbour).join(
            targets.withColumnRenamed("old_line", "neighbour"), ["pair_id", "neighbour"]
        )

    upper = offered(free, F.col("first") - 1).select(
        "pair_id", "old_line", "new_line", "first", "last"
    )
    reached = _scored(upper, texts, contexts, threshold)
    # Lines reaching the threshold without a gap from the first one on.
    order = Window.partitionBy("pair_id", "first").orderBy("old_line")
    forward = (
        reached.withColumn("rn", F.row_number().over(order))
        .where(F.col("old_line") - F.col("first") + 1 == F.col("rn"))
        .select("pair_id", "old_line", "new_line", "score")
    )
    lower = (
        offered(free.where("old_line = last"), F.col("last") + 1)
        .select("pair_id", "old_line", "new_line")
        .join(forward, ["pair_id", "old_line"], "left_anti")
    )
    backward = _scored(lower, texts, contexts, threshold)
    return forward.unionByName(backward)
