"""Lines of version files of any size: a file is read in blocks, by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetrace.functions.text import let
from linetrace.session import checkpointed
from linetrace.sources.lines import LINE_ENDS, decoded

BOM = "\ufeff"
BLOCK = ["path", "block"]


def _ended_parts(row: Column, ends: str) -> Column:
    """The lines inside a row that LF ends, as ``(text, ended)``.

    A CR at the end of the row belongs to its LF. ``ended`` tells whether the row
    itself holds the end of the line, LF left aside.
    """
    carriage = row.endswith("\r")
    body = F.when(carriage, F.expr("substr(decoded, 1, length(decoded) - 1)")).otherwise(row)

    def marked(parts: Column) -> Column:
        return F.transform(
            parts, lambda part, k: F.struct(part.alias("text"), ((k + 1 < F.size(parts)) | carriage).alias("ended"))
        )

    return let(F.split(body, ends, -1), marked)


def _file_rows(spark: SparkSession, path: str, mode: str, errors: str, pattern: str) -> DataFrame:
    """``path, block, size, octets, place, text, ended``: lines as they stand in their block.

    ``octets`` is the length of the row in its file, LF counted, on the first line of the row.
    ``place`` grows by one from line to line of a block.
    """
    content = F.col("value").cast("binary")
    found = spark.read.option("lineSep", "\n").text(path).withColumn("path", F.col("_metadata.file_path"))
    rows = found.where(F.col("path").rlike(pattern)).select(
        "path",
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        (F.octet_length("value") + 1).cast("bigint").alias("octets"),
        decoded(content, errors).alias("decoded"),
    )
    parts = rows.select(*BLOCK, "size", "octets", F.posexplode(_ended_parts(F.col("decoded"), LINE_ENDS[mode])).alias("k", "part"))
    return parts.select(
        *BLOCK, "size", F.when(F.col("k") == 0, F.col("octets")).otherwise(0).alias("octets"),
        F.monotonically_increasing_id().alias("place"), "part.*",
    )


def _block_table(rows: DataFrame) -> DataFrame:
    """One row a block: its first ``place``, the lines ``before`` it, the ``total`` of the file
    and ``missing``, the octets of the file that its rows do not hold.

    Only this table is ordered by file; its rows are as many as blocks.
    """
    blocks = rows.groupBy(*BLOCK).agg(
        F.min("place").alias("first"), F.count("*").alias("lines"), F.sum("octets").alias("octets"), F.first("size").alias("size")
    )
    whole = Window.partitionBy("path")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        *BLOCK, "first",
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"),
        F.sum("lines").over(whole).alias("total"),
        (F.first("size").over(whole) - F.sum("octets").over(whole)).alias("missing"),
    )


def read_lines(
    spark: SparkSession,
    path: str,
    mode: str = "newline",
    errors: str = "strict",
    pattern: str = r"file(\d+)-(old|new)",
) -> DataFrame:
    """``pair_id, side, line_no, text, has_eol`` of all files, as ``split_lines`` gives them for ``read_versions``.

    No value holds more than one line. The files are read twice: first the lines of each
    block are counted, which gives every block the number of its first line; then each
    line adds its place in its block. Both times the same listing is cut into the
    same blocks, so the settings for blocks must not change while the result is
    in use. ``line_no`` is a bigint: a file may have more lines than an int counts.

    The reader takes the byte order mark of a file away and does not tell whether the last
    line is ended; the file's length, compared with that of its rows, tells both. Files must not be compressed. Empty
    files, and those that hold the mark alone, have no lines; files whose path does not match ``pattern`` are left out.
    """
    rows = _file_rows(spark, path, mode, errors, pattern)
    numbered = rows.join(checkpointed(_block_table(rows)), BLOCK).withColumn(
        "line_no", F.col("place") - F.col("first") + F.col("before") + 1
    )
    # One octet too many: no LF after the last row. Three too few: the mark.
    last = (F.col("line_no") == F.col("total")) & F.col("missing").isin(-1, 2)
    marked = (F.col("line_no") == 1) & F.col("missing").isin(2, 3)
    return (
        # What follows the last end in a row without LF is no line if it is empty.
        numbered.where(~(last & ~F.col("ended") & (F.col("text") == "")))
        .select(
            F.regexp_extract("path", pattern, 1).alias("pair_id"),
            F.regexp_extract("path", pattern, 2).alias("side"),
            "line_no",
            F.when(marked, F.concat(F.lit(BOM), F.col("text"))).otherwise(F.col("text")).alias("text"),
            (~last | F.col("ended")).alias("has_eol"),
        )
    )
