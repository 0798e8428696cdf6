"""Two-column view of hunks and merge by a table of decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetrace.operators import align

# Default width, column separators and merge choices.
WIDTH = 130
SEPARATORS = {"equal": "   ", "replace": " | ", "delete": " < ", "insert": " > "}
LEFT, RIGHT = ("l", "1"), ("r", "2")
EDIT_NONE, EDIT_LEFT, EDIT_RIGHT = ("e",), ("el", "e1"), ("er", "e2")
EDIT_BOTH, EDIT_HEADERS = ("eb",), ("ed",)


def hunks_with_ends(lines: DataFrame) -> DataFrame:
    """Hunks over lines with their line end: ``a`` without one differs from ``a``."""
    return align.hunks(lines, key=F.struct("text", "has_eol"), autojunk=True)


def pair_status(steps: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, status``: 0 when a pair has no differing hunk, else 1."""
    differs = steps.groupBy("pair_id").agg(
        F.max((F.col("tag") != "equal").cast("int")).alias("status")
    )
    return (
        pairs.select("pair_id")
        .distinct()
        .join(differs, "pair_id", "left")
        .select("pair_id", F.coalesce("status", F.lit(0)).alias("status"))
    )


def hunk_sizes(steps: DataFrame) -> DataFrame:
    left, right = F.col("i2") - F.col("i1"), F.col("j2") - F.col("j1")
    return steps.select(
        "*",
        left.alias("left_lines"),
        right.alias("right_lines"),
        F.greatest(left, right).alias("rows"),
    )


def side_by_side(
    lines: DataFrame, steps: DataFrame, width: int = WIDTH, suppress_common: bool = False
) -> DataFrame:
    """``pair_id, hunk_no, row_no, row``: old text, separator, new text."""
    half = (width - 3) // 2
    if suppress_common:
        steps = steps.where("tag <> 'equal'")
    slots = hunk_sizes(steps).select(
        "pair_id",
        "hunk_no",
        "tag",
        "i1",
        "i2",
        "j1",
        "j2",
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row_no"),
    )
    old_no = F.when(F.col("i1") + F.col("row_no") <= F.col("i2"), F.col("i1") + F.col("row_no"))
    new_no = F.when(F.col("j1") + F.col("row_no") <= F.col("j2"), F.col("j1") + F.col("row_no"))

    def texts(side: str) -> DataFrame:
        return lines.where(F.col("side") == side).select(
            "pair_id", F.col("line_no").alias(f"{side}_no"), F.col("text").alias(f"{side}_text")
        )

    separator = F.create_map(*[F.lit(x) for item in SEPARATORS.items() for x in item])[F.col("tag")]
    return (
        slots.withColumn("old_no", old_no)
        .withColumn("new_no", new_no)
        .join(texts("old"), ["pair_id", "old_no"], "left")
        .join(texts("new"), ["pair_id", "new_no"], "left")
        .select(
            "pair_id",
            "hunk_no",
            "row_no",
            F.concat(
                F.rpad(F.coalesce("old_text", F.lit("")), half, " "),
                separator,
                F.substring(F.coalesce("new_text", F.lit("")), 1, half),
            ).alias("row"),
        )
    )


def _hunk_texts(lines: DataFrame, steps: DataFrame) -> DataFrame:
    """Hunks with the whole text of both sides, with and without forced line ends."""

    def side(name: str, start: str, end: str) -> DataFrame:
        members = steps.where(F.col(start) < F.col(end)).select(
            "pair_id",
            "hunk_no",
            F.explode(F.sequence(F.col(start) + 1, F.col(end))).alias("line_no"),
        )
        # Spark takes the rows behind an explode for as many as before it, and would broadcast all lines.
        members = members.hint("merge")
        ended = F.concat("text", F.when(F.col("has_eol"), "\n").otherwise(""))
        ordered = F.sort_array(
            F.collect_list(F.struct("line_no", ended.alias("raw"), F.concat("text", F.lit("\n")).alias("full")))
        )
        return (
            lines.where(F.col("side") == name)
            .join(members, ["pair_id", "line_no"])
            .groupBy("pair_id", "hunk_no")
            .agg(ordered.alias("rows"))
            .select(
                "pair_id",
                "hunk_no",
                F.array_join("rows.raw", "").alias(f"{name}_raw"),
                F.array_join("rows.full", "").alias(f"{name}_full"),
            )
        )

    joined = steps.join(side("old", "i1", "i2"), ["pair_id", "hunk_no"], "left").join(
        side("new", "j1", "j2"), ["pair_id", "hunk_no"], "left"
    )
    return joined.fillna("", ["old_raw", "old_full", "new_raw", "new_full"])


def _header(mark: str, name: str, start: str, end: str) -> Column:
    first, last = F.col(start) + 1, F.col(end)
    return (
        F.when(first > last, "")
        .when(first == last, F.concat(F.lit(f"{mark} {name} line "), first, F.lit("\n")))
        .otherwise(F.concat(F.lit(f"{mark} {name} lines "), first, F.lit("-"), last, F.lit("\n")))
    )


def merge(
    lines: DataFrame,
    steps: DataFrame,
    decisions: DataFrame,
    old_name: str = "old",
    new_name: str = "new",
    pairs: DataFrame | None = None,
) -> DataFrame:
    """``pair_id, merged``; null when a decision is missing, unknown or ``q``.

    ``pairs`` names all pairs: those without a line on either side merge to an empty text.

    Equal hunks keep the left text. ``l`` and ``r`` take a side. Edit choices take
    ``edited_text`` when given, otherwise the text an editor would start from: one
    side, both (``eb``), both under headers (``ed``) or nothing (``e``).
    """
    choice = F.lower(F.trim("choice"))
    both = F.concat("old_full", "new_full")
    headed = F.concat(
        _header("---", old_name, "i1", "i2"),
        "old_full",
        _header("+++", new_name, "j1", "j2"),
        "new_full",
    )
    seed = (
        F.when(choice.isin(*EDIT_NONE), "")
        .when(choice.isin(*EDIT_LEFT), F.col("old_full"))
        .when(choice.isin(*EDIT_RIGHT), F.col("new_full"))
        .when(choice.isin(*EDIT_BOTH), both)
        .when(choice.isin(*EDIT_HEADERS), headed)
    )
    piece = (
        F.when((F.col("tag") == "equal") | choice.isin(*LEFT), F.col("old_raw"))
        .when(choice.isin(*RIGHT), F.col("new_raw"))
        .when(seed.isNotNull(), F.coalesce("edited_text", seed))
    )
    chosen = (
        _hunk_texts(lines, steps)
        .join(decisions.hint("merge"), ["pair_id", "hunk_no"], "left")
        .select("pair_id", "hunk_no", piece.alias("piece"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("hunk_no", "piece")))
    merged = chosen.groupBy("pair_id").agg(
        F.when(
            F.bool_and(F.col("piece").isNotNull()), F.array_join(ordered["piece"], "")
        ).alias("merged")
    )
    if pairs is None:
        return merged
    lacking = pairs.select("pair_id").distinct().join(merged, "pair_id", "left_anti")
    return merged.union(lacking.select("pair_id", F.lit("").alias("merged")))


def facing_lines(steps: DataFrame) -> DataFrame:
    """Line pairs standing in one row of an equal or replace hunk, 1-based."""
    shared = F.least(F.col("i2") - F.col("i1"), F.col("j2") - F.col("j1"))
    return (
        steps.where("tag in ('equal', 'replace')")
        .select("pair_id", "i1", "j1", F.explode(F.sequence(F.lit(1), shared)).alias("k"))
        .select(
            "pair_id",
            (F.col("i1") + F.col("k")).alias("old_line"),
            (F.col("j1") + F.col("k")).alias("new_line"),
        )
    )
