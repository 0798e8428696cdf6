"""Mix sources to target weights: random order, prefix sums, exact budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetrace.llm.common import WHITE, packed, white_words, whole

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
#: Hex digits of the random key that name a range; a source has 16 to that power at most.
RANGE_DIGITS = 4


def n_words(text: Column) -> Column:
    return F.size(white_words(text)).cast("bigint")


def random_key(*parts: Column, seed: str = SEED) -> Column:
    """Hex digits that look random, the same in every run; nulls count as empty."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Add ``target`` to the table of sources ``(src, source_size)``, one row each.

    Sources in order of ``src`` weigh ``weights``, repeating, and share ``share`` times
    all sizes. A target stops at ``most`` times its source's size; what is over is shared
    by weight among the others until none is above. Closed form: by ascending ratio
    of limit to weight the first sources get their limit, the rest one level times weight.
    The table of sources is ordered in one task: a row for each source, not document.
    """
    numbered = sources.withColumn("no", F.row_number().over(Window.orderBy("src")) - 1)
    ratio = Window.orderBy("ratio", "no")
    before, after = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (
        numbered.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("no") % len(weights)))
        .withColumn("limit", most * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("all", share * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("place", F.row_number().over(ratio))
    )
    open_ = F.when(F.col("level") < F.col("ratio"), F.struct("place", "level"))
    return levels.withColumn("first", F.min(open_).over(everything)).select(
        "src",
        "source_size",
        F.coalesce(F.least("limit", F.col("first.level") * F.col("weight")), F.col("limit")).cast("double").alias("target"),
    )


def mix(
    rows: DataFrame,
    source: Column,
    size: Column,
    key: Column,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    digits: int = RANGE_DIGITS,
) -> DataFrame:
    """Each row as struct ``row`` with ``size, source_size, target, taken``.

    ``key`` holds random hex digits that order the rows of a source. A source's budget
    is its rounded target: as many whole epochs as it holds, then rows in order of key
    up to the exact word, so the last row may be taken in part. ``taken`` counts the
    words taken, repeats included, and sums to the budget in every source with words.

    Key ranges are the unit of work: sums per source and range, prefix sums over
    ranges, then a running sum inside each range, so no task holds a source. Null
    sources are one source, the last; sizes of null count 0 and take 0; rows that
    repeat with their key are interchangeable. No rows give no rows.
    """
    keyed = packed(
        rows,
        src=F.struct(source.isNull().alias("missing"), F.coalesce(source, F.lit("")).alias("name")),
        size=F.coalesce(size, F.lit(0)).cast("bigint"),
        key=key,
    ).withColumn("range", F.substring("key", 1, digits))
    sums = keyed.groupBy("src", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(sums.groupBy("src").agg(F.sum("range_size").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))).join(targets, "src")
    inside = Window.partitionBy("src", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    before = F.col("offset") + F.coalesce("inside", F.lit(0))
    return (
        keyed.withColumn("inside", F.sum("size").over(inside))
        .join(offsets.drop("range_size"), ["src", "range"])
        .select(
            "row",
            "size",
            "source_size",
            "target",
            (epochs * F.col("size") + F.greatest(F.lit(0), F.least("size", rest - before))).cast("bigint").alias("taken"),
        )
    )


def first_words(text: Column, count: Column) -> Column:
    """The text up to its word number ``count``, white space in front of it as it is."""
    leading = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    rest = F.element_at(F.split(text, WHITE, (count + 1 + leading).cast("int")), -1)
    return F.rtrim(F.left(text, F.length(text) - F.length(rest)))


def mixed_documents(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    **options,
) -> DataFrame:
    """The documents of the mix, columns as they are: repeated, left out or cut.

    A document appears once for every epoch that takes it whole; the one at the
    budget's end appears once more with as many of its first words as are left.
    """
    text = F.col(f"`{text_column}`")
    mixed = mix(
        documents,
        F.col(f"`{source_column}`"),
        n_words(text),
        random_key(F.col(f"`{id_column}`"), F.md5(whole(text))),
        **options,
    )
    copies = mixed.where("taken > 0").select(
        "row", "size", F.explode(F.expr("transform(sequence(0, (taken - 1) div size), k -> least(size, taken - k * size))")).alias("part")
    )
    cut = F.when(F.col("part") < F.col("size"), first_words(F.col(f"row.{text_column}"), F.col("part")))
    out = F.coalesce(cut, F.col(f"row.{text_column}"))
    return copies.select(
        *[(out if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in documents.columns]
    )
