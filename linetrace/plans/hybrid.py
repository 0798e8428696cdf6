"""Hybrid mapping: exact lines, then scored candidates, then splits and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetrace.operators import align, assign, candidates, context, expand
from linetrace.session import checkpointed

# Smallest scores for a match, a split and a merge.
MATCH_SCORE = 0.35
SPLIT_SCORE = 0.65
MERGE_SCORE = 0.65


def _kind(edges: DataFrame, kind: str) -> DataFrame:
    score = F.col("score") if "score" in edges.columns else F.lit(1.0)
    return edges.select(
        "pair_id", "old_line", "new_line", F.lit(kind).alias("kind"), score.alias("score")
    )


def exact_nonblank(pre_lines: DataFrame) -> DataFrame:
    """Edges of the exact alignment of normal lines, blank lines dropped afterwards."""
    steps = align.hunks(pre_lines, key="pre", autojunk=False)
    old = pre_lines.where("side = 'old' and pre <> ''").select(
        "pair_id", F.col("line_no").alias("old_line")
    )
    return align.exact_edges(steps).join(old, ["pair_id", "old_line"], "left_semi")


def _open(features: DataFrame, edges: DataFrame, side: str) -> DataFrame:
    """Features of the lines of one side that no edge names."""
    used = edges.select("pair_id", F.col(f"{side}_line").alias("line_no"))
    return features.where(F.col("side") == side).join(used, ["pair_id", "line_no"], "left_anti")


def map_hybrid(
    lines: DataFrame,
    k: int = candidates.CANDIDATES,
    match_score: float = MATCH_SCORE,
    split_score: float = SPLIT_SCORE,
    merge_score: float = MERGE_SCORE,
) -> DataFrame:
    """m:n line mapping: ``pair_id, old_line, new_line, kind, score``."""
    pre = checkpointed(context.normal_lines(lines))
    exact = checkpointed(exact_nonblank(pre))
    # Written once by pair: every later step reads structure and context from here.
    features = checkpointed(context.structured(context.context_of(pre)))
    scored = candidates.score_candidates(
        _open(features, exact, "old"), _open(features, exact, "new"), match_score, k
    )
    chosen = assign.assign_greedy(scored, match_score)
    primary = checkpointed(_kind(exact, "exact").unionByName(_kind(chosen, "greedy")))
    contexts = features.select(*pre.columns, "ctx")
    texts = features.drop("ctx")
    split = expand.split_edges(primary, texts, contexts, split_score)
    mapped = checkpointed(primary.unionByName(_kind(split, "split")))
    merged = expand.merge_edges(mapped, texts, contexts, merge_score)
    return mapped.unionByName(_kind(merged, "merge"))
