"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetrace.session import checkpointed


#: Up to so many links are kept in one part, where rounds shuffle nothing.
ONE_PART = 1 << 16


def _large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on its smallest neighbour."""
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
    both = both.select("l.a", "l.b")
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    ends = F.array(F.col("a"), F.when(F.col("b") != F.col("least"), F.col("b")))
    moved = links.join(least, "a").select(F.explode(ends).alias("a"), F.col("least").alias("b"))
    return moved.where("a is not null").distinct()


def _in_parts(links: DataFrame, count: int) -> DataFrame:
    return links.coalesce(1) if count <= ONE_PART else links


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the undirected links ``(a, b)``.

    ``root`` is the smallest node of the component. Rounds of large and small stars
    halve the depth of the trees, so a chain of n links takes about log n rounds. A table of no more than
    ``ONE_PART`` links is one task a round; tasks of a few links each would cost more than their work.
    Links of null, loops and repeated links change nothing; no links give no rows.
    Only a count and a checksum reach the driver.
    """
    stars = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(stars)
    while mark[0]:
        stars = checkpointed(_small_star(_large_star(_in_parts(stars, mark[0]))))
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
