"""Versions (one row per file version) and lines (one row per line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetrace.functions.text import let

# What ends a line. Text is always opened with CR LF and CR read as
# LF; the Unicode rule also ends lines at the separators below.
NEWLINE = r"\r\n|[\r\n]"
UNICODE_NEWLINE = r"\r\n|[\r\n\x0b\x0c\x1c-\x1e\x85  ]"
LINE_ENDS = {"newline": NEWLINE, "unicode": UNICODE_NEWLINE}


def decoded(content: Column, errors: str = "strict") -> Column:
    """Bytes as text; ``errors`` says what bytes that are not UTF-8 do: fail or become U+FFFD."""
    if errors not in ("strict", "replace"):
        raise ValueError("errors must be 'strict' or 'replace'")
    if errors == "strict":
        return F.decode(content, "UTF-8")
    return F.make_valid_utf8(content.cast("string"))


def read_versions(
    spark: SparkSession,
    path: str,
    errors: str = "strict",
    pattern: str = r"file(\d+)-(old|new)",
) -> DataFrame:
    """Read version files; ``pattern`` takes pair id and side from the path.

    ``errors='strict'`` fails on bytes that are not UTF-8, ``'replace'`` puts
    U+FFFD in their place.
    """
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            F.regexp_extract("path", pattern, 1).alias("pair_id"),
            F.regexp_extract("path", pattern, 2).alias("side"),
            decoded(F.col("content"), errors).alias("text"),
        )
        .where("pair_id <> ''")
    )


def complete_pairs(versions: DataFrame) -> DataFrame:
    """Keep the pairs of which both sides were found."""
    both = (
        versions.groupBy("pair_id")
        .agg(F.count_distinct("side").alias("sides"))
        .where("sides = 2")
        .select("pair_id")
    )
    return versions.join(both, "pair_id", "left_semi")


def versions_of_pairs(pairs: DataFrame) -> DataFrame:
    """``(pair_id, old_text, new_text)`` as one row per version."""
    return pairs.select(
        "pair_id", F.expr("stack(2, 'old', old_text, 'new', new_text) as (side, text)")
    )


def split_lines(versions: DataFrame, mode: str = "newline") -> DataFrame:
    """One row per line: ``pair_id, side, line_no, text, has_eol``.

    A line end at the end of the text makes no extra line. ``has_eol`` is false
    only for a last line without one. The text is split once: an outer explode
    keeps the optimizer from testing the array in an added filter of its own.
    """
    ends = LINE_ENDS[mode]
    last = f"(?:{ends})\\z"
    closed = F.col("text").rlike(last)
    body = F.regexp_replace("text", last, "")

    def numbered(parts: Column) -> Column:
        return F.transform(
            parts,
            lambda part, k: F.struct(
                part.alias("text"), (F.col("closed") | (k + 1 < F.size(parts))).alias("has_eol")
            ),
        )

    rows = F.when(F.col("text") != "", let(F.split("body", ends, -1), numbered))
    return (
        versions.select("pair_id", "side", "text", closed.alias("closed"), body.alias("body"))
        .select("pair_id", "side", F.posexplode_outer(rows).alias("pos", "line"))
        .where("pos is not null")
        .select(
            "pair_id", "side", (F.col("pos") + 1).alias("line_no"), "line.text", "line.has_eol"
        )
    )


def read_golden(spark: SparkSession, path: str, pattern: str = r"matchings(\d+)") -> DataFrame:
    """Hand-made mappings: rows ``a, b -> c, d`` become their edges.

    ``OLD i`` and ``NEW j`` rows give an edge with the other side null, as does
    ``i -> -``. Other rows are headings.
    """
    # The grammar of the mapping files.
    edge = r"^\s*([\d, ]+?)\s*->\s*([\d, ]+|-)\s*$"
    alone = r"^(OLD|NEW) (\d+)$"

    def numbers(column: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(column, F.lit(r"(\d+)"), 1), lambda x: x.cast("int")
        )

    rows = spark.read.text(path).select(
        F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias("pair_id"), "value"
    )
    kind = F.regexp_extract("value", alone, 1)
    number = F.array(F.regexp_extract("value", alone, 2).cast("int"))
    nothing = F.array().cast("array<int>")
    return (
        rows.where(F.col("value").rlike(edge) | F.col("value").rlike(alone))
        .select(
            "pair_id",
            F.when(kind == "OLD", number)
            .when(kind == "NEW", nothing)
            .otherwise(numbers(F.regexp_extract("value", edge, 1)))
            .alias("olds"),
            F.when(kind == "NEW", number)
            .when(kind == "OLD", nothing)
            .otherwise(numbers(F.regexp_extract("value", edge, 2)))
            .alias("news"),
        )
        .select("pair_id", F.explode_outer("olds").alias("old_line"), "news")
        .select("pair_id", "old_line", F.explode_outer("news").alias("new_line"))
    )
