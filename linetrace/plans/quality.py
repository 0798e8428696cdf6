"""Precision and recall of a mapping against hand-made edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGE = ["pair_id", "old_line", "new_line"]


def quality(mapping: DataFrame, golden: DataFrame, lines: DataFrame) -> DataFrame:
    """``pair_id, found, expected, hits, precision, recall, f1`` over non-blank old lines."""
    filled = lines.where("side = 'old' and trim(text) <> ''").select(
        "pair_id", F.col("line_no").alias("old_line")
    )

    def edges(df: DataFrame) -> DataFrame:
        complete = df.select(*EDGE).where("old_line is not null and new_line is not null")
        return complete.distinct().join(filled, ["pair_id", "old_line"], "left_semi")

    marked = (
        edges(mapping)
        .withColumn("f", F.lit(1))
        .join(edges(golden).withColumn("e", F.lit(1)), EDGE, "full_outer")
    )
    counts = marked.groupBy("pair_id").agg(
        F.count("f").alias("found"),
        F.count("e").alias("expected"),
        F.count_if(F.col("f").isNotNull() & F.col("e").isNotNull()).alias("hits"),
    )
    share = lambda whole: F.when(F.col(whole) > 0, F.col("hits") / F.col(whole))
    both = F.col("found") + F.col("expected")
    return counts.select(
        "*",
        share("found").alias("precision"),
        share("expected").alias("recall"),
        (2 * F.col("hits") / both).alias("f1"),
    )
