"""Greedy one-to-one choice among scored line pairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linetrace.session import checkpointed, first_of_groups

FOLD_EDGES = 20_000


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _take_free(olds: pd.Series, news: pd.Series) -> pd.Series:
    def take(old, new):
        used_old, used_new, taken = set(), set(), []
        for at, (i, j) in enumerate(zip(old.tolist(), new.tolist())):
            if i not in used_old and j not in used_new:
                used_old.add(i)
                used_new.add(j)
                taken.append(at)
        return taken

    return pd.Series([take(o, n) for o, n in zip(olds, news)])


def _rank() -> Column:
    return F.struct("score", "old_line", "new_line")


def _fold(edges: DataFrame) -> DataFrame:
    ordered = edges.groupBy("pair_id").agg(F.sort_array(F.collect_list(_rank()), asc=False).alias("e"))
    return (
        ordered.withColumn("taken", _take_free("e.old_line", "e.new_line"))
        .select("pair_id", F.explode(F.transform("taken", lambda at: F.get("e", at))).alias("t"))
        .select("pair_id", "t.old_line", "t.new_line", "t.score")
    )


def _mutual_best(edges: DataFrame) -> DataFrame:
    tops = {side: edges.groupBy("pair_id", side).agg(F.max(_rank()).alias("top")) for side in ("old_line", "new_line")}
    both = tops["old_line"].join(tops["new_line"], ["pair_id", "top"])
    return both.select("pair_id", "top.old_line", "top.new_line", "top.score")


def _without_lines_of(edges: DataFrame, taken: DataFrame) -> DataFrame:
    for side in ("old_line", "new_line"):
        edges = edges.join(taken.select("pair_id", side), ["pair_id", side], "left_anti")
    return edges


def _first(edges: DataFrame, count: int) -> DataFrame:
    backwards = {f"minus_{c}": -F.col(c) for c in ("score", "old_line", "new_line")}
    return first_of_groups(edges.withColumns(backwards), ["pair_id"], list(backwards), count).drop(*backwards)


def assign_greedy(
    edges: DataFrame, threshold: float = 0.0, fold_edges: int = FOLD_EDGES
) -> DataFrame:
    """Take edges in the order (score, old line, new line), all descending.

    Edges below ``threshold`` or without a score are left out.

    An edge is taken when both its lines are free. A pair with at most
    ``fold_edges`` edges is one sorted row. Larger pairs go in rounds, with the same
    result: first every edge is taken that is first for both of its lines, then the first
    ``fold_edges`` of the edges left are folded, which decides all of them. Where
    scores are mixed the first step takes a share of all lines; where each edge waits for the
    one before, the second still decides ``fold_edges`` a round.
    """
    edges = checkpointed(edges.select("pair_id", "old_line", "new_line", "score"))
    result, left = None, edges.where(F.col("score") >= threshold)
    while True:
        large = left.groupBy("pair_id").count().where(F.col("count") > fold_edges).select("pair_id")
        large = checkpointed(large)
        folded = _fold(left.join(large, "pair_id", "left_anti"))
        result = folded if result is None else result.unionByName(folded)
        if large.isEmpty():
            return result
        left = left.join(large, "pair_id", "left_semi")
        mutual = checkpointed(_mutual_best(left))
        left = checkpointed(_without_lines_of(left, mutual))
        # The folded edges are decided: those not taken have a line of one that is.
        taken = checkpointed(_fold(_first(left, fold_edges)))
        left = checkpointed(_without_lines_of(left, taken))
        result = result.unionByName(mutual).unionByName(taken)
