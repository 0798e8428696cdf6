"""Compare line k of the old version with line k of the new one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_positional(lines: DataFrame) -> DataFrame:
    """``pair_id, line_no, status, old_text, new_text``; one row per line number."""
    old = lines.where("side = 'old'").select("pair_id", "line_no", F.col("text").alias("old_text"))
    new = lines.where("side = 'new'").select("pair_id", "line_no", F.col("text").alias("new_text"))
    status = (
        F.when(F.col("old_text").isNull(), "added")
        .when(F.col("new_text").isNull(), "removed")
        .when(F.col("old_text") == F.col("new_text"), "same")
        .otherwise("changed")
    )
    return old.join(new, ["pair_id", "line_no"], "full_outer").select(
        "pair_id", "line_no", status.alias("status"), "old_text", "new_text"
    )
