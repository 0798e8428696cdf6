"""Line features of the hybrid method: normal form, structure, context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetrace.functions import text as T

# Fixed value.
CONTEXT_LINES = 4
#: Lines of a version that one task numbers and frames at a time.
BLOCK_LINES = 1 << 14


def normal_lines(lines: DataFrame) -> DataFrame:
    """``pair_id, side, line_no, pre``; a blank line has an empty ``pre``."""
    return lines.select("pair_id", "side", "line_no", T.normal_line(F.col("text")).alias("pre"))


def structured(pre_lines: DataFrame) -> DataFrame:
    """Add structural tokens, their string and their fingerprint."""
    return (
        pre_lines.withColumn("struct", T.structure(F.col("pre")))
        .withColumn("struct_str", F.array_join("struct", " "))
        .withColumn("simhash", T.fingerprint("struct"))
    )


def _neighbours_of_blocks(rows: DataFrame, window: int) -> DataFrame:
    """``pair_id, side, block, above, below``: the lines next to a block of a version of several.

    ``above`` has the nearest first. A block in ``rows`` has a line at least, so
    ``window`` blocks on each side are enough. Every block gives its first and
    last lines alone, which are all that is ordered by version.
    """
    long = rows.where("block > 0").select("pair_id", "side").distinct()
    at = F.struct("line_no", "pre")
    inside = Window.partitionBy("pair_id", "side", "block")
    first, last = (F.row_number().over(inside.orderBy(o)) for o in (F.asc("line_no"), F.desc("line_no")))
    edges = rows.join(long, ["pair_id", "side"], "left_semi").withColumn("first", first).withColumn("last", last)

    def lines(place: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(F.col(place) <= window, at))), lambda s: s["pre"])

    blocks = edges.groupBy("pair_id", "side", "block").agg(lines("first").alias("heads"), lines("last").alias("tails"))
    order = Window.partitionBy("pair_id", "side").orderBy("block")
    above = F.flatten(F.collect_list("tails").over(order.rowsBetween(-window, -1)))
    below = F.flatten(F.collect_list("heads").over(order.rowsBetween(1, window)))
    return blocks.select(
        "pair_id", "side", "block",
        F.slice(F.reverse(above), 1, window).alias("above"), F.slice(below, 1, window).alias("below"),
    )


def context_of(pre_lines: DataFrame, window: int = CONTEXT_LINES, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Add ``ctx`` to the non-blank lines: the lines around each, nearest first above.

    Up to ``window`` non-blank lines before, then as many after, joined by blanks.
    The windows stream over blocks of a version, so a long version is spread over
    many tasks; what a block needs of its neighbours is joined to it.
    """
    block = F.expr(f"(line_no - 1) div {block_lines}")
    rows = pre_lines.where("pre <> ''").withColumn("block", block)
    key = ["pair_id", "side", "block"]
    order = Window.partitionBy(*key).orderBy("line_no")
    before = F.reverse(F.collect_list("pre").over(order.rowsBetween(-window, -1)))
    after = F.collect_list("pre").over(order.rowsBetween(1, window))
    nothing = F.array().cast("array<string>")
    near = F.concat(
        F.slice(F.concat("before", F.coalesce("above", nothing)), 1, window),
        F.slice(F.concat("after", F.coalesce("below", nothing)), 1, window),
    )
    inside = rows.withColumn("before", before).withColumn("after", after)
    if rows.where("block > 0").isEmpty():
        joined = inside.withColumn("above", nothing).withColumn("below", nothing)
    else:
        joined = inside.join(_neighbours_of_blocks(rows, window), key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in pre_lines.columns], F.array_join(near, " ").alias("ctx"))


def context_bags(with_context: DataFrame, prefix: str = "") -> DataFrame:
    """Replace ``ctx`` by its word counts ``bag`` and their ``norm``; all three names may have a prefix."""
    words: Column = F.filter(F.split(f"{prefix}ctx", " "), lambda w: w != "")
    return (
        with_context.withColumn(f"{prefix}bag", T.bag(words))
        .withColumn(f"{prefix}norm", T.bag_norm(F.col(f"{prefix}bag")))
        .drop(f"{prefix}ctx")
    )
