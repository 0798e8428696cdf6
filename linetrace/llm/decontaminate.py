"""Benchmark passages in documents, found by winnowed word fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetrace.llm.common import LOWER, UPPER, ascii_lower, packed, pieces, text_key, whole
from linetrace.session import checkpointed

#: Words of a window that counts as shared.
SPAN = 13
#: Words of a hashed gram; a window holds ``SPAN - GRAM + 1`` of them.
GRAM = 8
#: What separates words: everything but digits, ASCII letters and letters beyond ASCII.
OUTSIDE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Words before lower-casing."""
    return pieces(whole(text), OUTSIDE)


def _lowered(word: Column) -> Column:
    """A-Z lower-cased: only the few words with capitals take the slow way."""
    return F.when(F.lower(word) == word, word).otherwise(ascii_lower(word))


def _minima(words: str, span: int, gram: int) -> Column:
    """Least gram hash of every window of ``span`` words; ``h`` holds the word hashes."""
    return F.expr(
        f"transform(sequence(0, size({words}) - {span}), i -> least("
        + ", ".join(f"g[i + {k}]" for k in range(span - gram + 1))
        + "))"
    )


def winnowed(df: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Add ``minima`` to rows with ``words``: one hash for each window of ``span`` words.

    The hash is the least of the window's gram hashes, so equal windows have equal
    ones, and it lasts over neighbouring windows: few distinct hashes stand for all.
    Texts shorter than a window have null.
    """
    gram_hash = "transform(h, (x, i) -> xxhash64(x, " + ", ".join(f"get(h, i + {k})" for k in range(1, gram)) + "))"
    return (
        df.withColumn("h", F.when(F.size("words") >= span, F.transform("words", lambda w: F.xxhash64(_lowered(w)))))
        .withColumn("g", F.expr(gram_hash))
        .withColumn("minima", F.when(F.col("g").isNotNull(), _minima("words", span, gram)))
        .drop("h", "g")
    )


def _window_text(words: str, start: str, length: str) -> Column:
    return F.expr(f"array_join(slice({words}, {start} + 1, {length}), ' ')")


def _by_length(columns: dict[int, str], of: str, each: str) -> Column:
    """``prints``: the hashes of all window lengths in one array of structs."""
    parts = [
        f"transform({of.format(f'coalesce({column}, cast(array() as array<bigint>))')}, {each.format(length)})"
        for length, column in columns.items()
    ]
    return F.expr(f"concat({', '.join(parts)})").alias("prints")


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, span: int) -> DataFrame:
    """``(win, items)``: each window of the benchmark and the sorted ids it occurs in.

    An item of fewer words is one window.
    """
    items = benchmark.select(
        F.col(f"`{id_column}`").cast("string").alias("item"),
        F.transform(_words(F.col(f"`{text_column}`")), _lowered).alias("words"),
    ).where(F.size("words") > 0)
    starts = items.withColumn("length", F.least(F.lit(span), F.size("words"))).select(
        "item", "words", "length", F.explode(F.expr("sequence(0, size(words) - length)")).alias("s")
    )
    windows = starts.select("item", "length", _window_text("words", "s", "length").alias("win"))
    return windows.groupBy("win", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """``(doc_id, h1, h2, n_words, n_hit, items)`` of every document.

    ``n_hit`` words of the document lie in windows of ``span`` words that also occur
    in a benchmark item; ``items`` lists the ids of those items as sorted strings.
    Words are lower-cased in A-Z. An item of fewer words is one window of its own length.
    ``h1, h2`` name the text. Null and word-less texts have no words and no hit; such
    items match nothing; an item with a null id counts for hits but is not listed. Repeated rows stay rows. Other
    columns are not looked at; an empty benchmark hits nothing.

    Guarantee: every shared window has the same least gram hash on both sides, so it is
    found; candidates are then compared word by word and hits grow to all windows
    of the text whose hash is shared.
    """
    windows = checkpointed(item_windows(benchmark, item_id, item_text, span))
    words_of_window = windows.withColumn("words", F.split("win", " "))
    long_hashes = winnowed(words_of_window.where(F.col("length") == span), span, gram).select(
        F.lit(span).alias("length"), F.explode_outer("minima").alias("hash")
    )
    short_hashes = words_of_window.where(F.col("length") < span).select(
        "length", F.xxhash64(F.transform("words", lambda w: F.xxhash64(w))).alias("hash")
    )
    hashes = checkpointed(long_hashes.union(short_hashes).distinct())
    # At most span - 1 numbers.
    short = sorted(r[0] for r in windows.where(F.col("length") < span).select("length").distinct().collect())

    def fingerprints(df: DataFrame) -> DataFrame:
        """Add ``prints``: ``(length, s, hash)`` arrays by window length."""
        df = winnowed(df, span, gram)
        for length in short:
            lowered = f"if(lower(w) = w, w, translate(w, '{UPPER}', '{LOWER}'))"
            part = F.expr(
                f"transform(sequence(0, size(words) - {length}), i ->"
                f" xxhash64(transform(slice(words, i + 1, {length}), w -> xxhash64({lowered}))))"
            )
            df = df.withColumn(f"short{length}", F.when(F.size("words") >= length, part))
        return df

    columns = {span: "minima"} | {n: f"short{n}" for n in short}
    texts = documents.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_id"),
        text_key(whole(F.col(f"`{text_column}`"))).alias("key"),
        _words(F.col(f"`{text_column}`")).alias("words"),
    )
    marked = fingerprints(texts)
    prints = _by_length(columns, "array_distinct({})", "x -> named_struct('length', {}, 'hash', x)")
    kept = ["row_id", "doc_id", "h1", "h2", "n_words"]
    slim = marked.select("row_id", "doc_id", "key.h1", "key.h2", F.size("words").cast("bigint").alias("n_words"), prints)
    probes = slim.select(*kept, F.explode_outer("prints").alias("p")).select(*kept, "p.length", "p.hash")
    found = hashes.withColumn("hit", F.lit(1))
    profile = checkpointed(
        probes.join(found, ["length", "hash"], "left")
        .groupBy(*kept)
        .agg(F.max("hit").alias("hit"))
        .drop("row_id")
    )
    suspects = checkpointed(profile.where("hit = 1").select("h1", "h2").distinct())

    # The texts with a shared hash, each once, and all their windows that share one.
    again = documents.select(whole(F.col(f"`{text_column}`")).alias("text"))
    again = again.select("text", text_key(F.col("text")).alias("key")).select("text", "key.h1", "key.h2")
    again = again.join(suspects, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    again = fingerprints(again.select("h1", "h2", _words(F.col("text")).alias("words")))
    arrays = _by_length(columns, "{}", "(x, i) -> named_struct('length', {}, 's', i, 'hash', x)")
    lowered = F.transform("words", _lowered)
    placed = checkpointed(again.select("h1", "h2", lowered.alias("words"), arrays))
    near = placed.select("h1", "h2", F.explode("prints").alias("p")).select("h1", "h2", "p.length", "p.s", "p.hash")
    near = near.join(hashes, ["length", "hash"], "left_semi")
    starts = near.groupBy("h1", "h2").agg(F.collect_list(F.struct("s", "length")).alias("starts"))
    candidates = (
        placed.select("h1", "h2", "words")
        .join(starts, ["h1", "h2"])
        .select("h1", "h2", F.explode(F.transform("starts", lambda x: F.struct(
            x["s"].alias("s"), x["length"].alias("length"),
            F.array_join(F.slice("words", x["s"] + 1, x["length"]), " ").alias("win")))).alias("c"))
        .select("h1", "h2", "c.*")
    )
    hits = candidates.join(windows, ["win", "length"])
    grown = (
        "aggregate(array_sort(spans), named_struct('total', 0L, 'end', 0), (a, x) -> named_struct("
        "'total', a.total + greatest(0, x.s + x.length - greatest(x.s, a.end)),"
        " 'end', greatest(a.end, x.s + x.length)), a -> a.total)"
    )
    result = checkpointed(
        hits.groupBy("h1", "h2")
        .agg(F.collect_list(F.struct("s", "length")).alias("spans"), F.collect_set("items").alias("lists"))
        .select("h1", "h2", F.expr(grown).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"))
    )
    return profile.join(result, ["h1", "h2"], "left").select(
        "doc_id", "h1", "h2", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


#: A document is contaminated if at least one in so many of its words is hit.
PART = 20


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (PART * F.col("n_hit") >= F.col("n_words"))


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents that are not contaminated, columns as they are."""
    found = contamination(documents, benchmark, id_column, text_column, item_id, item_text)
    gone = checkpointed(found.where(is_contaminated()).select(F.struct("h1", "h2").alias("gone")).distinct())
    marked = packed(documents, key=text_key(whole(F.col(f"`{text_column}`"))))
    return marked.join(gone, F.col("key") == F.col("gone"), "left_anti").select("row.*")
