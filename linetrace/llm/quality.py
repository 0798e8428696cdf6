"""Quality rules as a short-circuit cascade, ordered by rejection per cost."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetrace.llm.common import packed, white_words, whole
from linetrace.session import checkpointed, keep_where

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3
SAMPLE_ROWS = 2000
SAMPLE_SEED = 11


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``condition`` holds over ``n_words`` and the metrics."""

    name: str
    condition: str
    metrics: tuple[str, ...] = ()


#: Given rules: a document that fails one is rejected whatever the others say.
BASE_RULES = (
    Rule("short", "n_words < 50"),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words", ("n_repeat_words",)),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "10 * n_symbols > 4 * n_words", ("n_symbols",)),
    Rule("capitals", "2 * n_upper > word_chars", ("n_upper", "word_chars")),
    Rule("lines", "5 * n_dup_lines > n_words", ("n_dup_lines",)),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words", ("word_chars",)),
)


def _word_chars(df: DataFrame, due: Column) -> DataFrame:
    return df.withColumn("word_chars", F.when(due, F.length(F.array_join("words", "")).cast("bigint")))


def _n_symbols(df: DataFrame, due: Column) -> DataFrame:
    return df.withColumn("n_symbols", F.when(due, F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint")))


def _n_upper(df: DataFrame, due: Column) -> DataFrame:
    return df.withColumn("n_upper", F.when(due, F.regexp_count("text", F.lit("[A-Z]")).cast("bigint")))


def _n_dup_lines(df: DataFrame, due: Column) -> DataFrame:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        df.withColumn("lines", F.when(due, lines))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"))
        .drop("lines")
    )


def _n_repeat_words(df: DataFrame, due: Column) -> DataFrame:
    """Words inside a window of ``WINDOW`` words that the text holds twice or more.

    Hash and place of every window share one number, the place in the low bits, so
    that a sort of plain numbers brings equal windows together. Neighbours that
    agree in the high bits are compared by the whole 64-bit hash.
    """
    window = F.transform(
        "words", lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WINDOW)])
    )
    many = due & (F.size("words") >= WINDOW)
    return (
        df.withColumn("hashes", F.when(many, F.slice(window, F.lit(1), F.size("words") - (WINDOW - 1))))
        .withColumn("shift", F.length(F.bin(F.size("hashes"))))
        .withColumn(
            "sorted",
            F.when(
                F.size(F.array_distinct("hashes")) < F.size("hashes"),
                F.expr("sort_array(transform(hashes, (h, i) -> shiftleft(h, shift) | cast(i as bigint)))"),
            ),
        )
        .withColumn("low", F.expr("shiftleft(1L, shift) - 1"))
        .withColumn(
            "pairs",
            F.expr(
                "filter(sequence(0, size(sorted) - 2), k -> shiftright(sorted[k] ^ sorted[k + 1], shift) = 0"
                " and hashes[int(sorted[k] & low)] = hashes[int(sorted[k + 1] & low)])"
            ),
        )
        .withColumn(
            "places",
            F.expr(
                "sort_array(array_distinct(flatten(transform(pairs, k ->"
                " array(int(sorted[k] & low), int(sorted[k + 1] & low))))))"
            ),
        )
        .withColumn(
            "n_repeat_words",
            F.when(
                due,
                F.coalesce(
                    F.expr(
                        "aggregate(transform(places, (p, k) ->"
                        f" least({WINDOW}, coalesce(get(places, k + 1), p + {WINDOW}) - p)), 0, (t, x) -> t + x)"
                    ),
                    F.lit(0),
                ).cast("bigint"),
            ),
        )
        .drop("hashes", "shift", "sorted", "low", "pairs", "places")
    )


METRICS = {
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_upper": _n_upper,
}


def _cascaded(documents: DataFrame, text_column: str, rules: list[Rule], audit: bool) -> DataFrame:
    """``row``, ``n_words``, metrics and ``rejected_by``, rules tried in their order.

    A metric is computed only where no earlier rule has rejected; ``audit`` computes
    all of them everywhere.
    """
    df = packed(documents, text=whole(F.col(f"`{text_column}`")))
    df = df.withColumn("words", white_words(F.col("text")))
    df = df.withColumn("n_words", F.size("words").cast("bigint"))
    df = df.withColumn("rejected_by", F.lit(None).cast("string"))
    for rule in rules:
        open_ = F.col("rejected_by").isNull()
        for metric in rule.metrics:
            if metric not in df.columns:
                df = METRICS[metric](df, F.lit(True) if audit else open_)
        df = df.withColumn(
            "rejected_by", F.when(open_ & F.expr(rule.condition), F.lit(rule.name)).otherwise(F.col("rejected_by"))
        )
    return df.drop("text", "words")


def cascade_order(
    documents: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejected documents per second of computing, best first.

    Both are measured on a random sample of about ``sample_rows`` documents. After
    each choice a rule counts only for sample documents that the chosen ones let
    pass. The order changes which rule rejects, never what is kept.
    """
    n_rows = documents.count()
    share = min(1.0, sample_rows / max(n_rows, 1))
    sample = checkpointed(documents.select(text_column).sample(share, SAMPLE_SEED))

    def seconds(chosen: list[Rule]) -> float:
        start = time.perf_counter()
        _cascaded(sample, text_column, chosen, True).agg(F.count("rejected_by")).collect()
        return time.perf_counter() - start

    seconds([])
    floor = seconds([])
    cost = {rule: max(seconds([rule]) - floor, 0.005) for rule in rules}
    flags = _cascaded(sample, text_column, [r for r in rules if r.metrics], True)
    seen = (
        flags.select(*[F.expr(rule.condition).alias(f"r{k}") for k, rule in enumerate(rules)])
        .groupBy(*[f"r{k}" for k in range(len(rules))])
        .count()
        .collect()
    )
    order, left, cases = [], list(enumerate(rules)), [tuple(row) for row in seen]
    while left:
        best = max(left, key=lambda item: sum(c[-1] for c in cases if c[item[0]]) / cost[item[1]])
        order.append(best[1])
        left.remove(best)
        cases = [c for c in cases if not c[best[0]]]
    return order


def quality_report(
    documents: DataFrame,
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
    audit: bool = False,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Every document as struct ``row`` with ``n_words``, metrics and ``rejected_by``.

    ``rejected_by`` is the first rule of the cascade that rejects, null for documents
    that are kept. Without ``audit`` the metrics behind the rejecting rule are null.
    A null or empty text has no words. Repeated rows stay rows; other columns, nulls
    among them, are carried in ``row`` whatever their names; no rows give no rows.
    """
    order = cascade_order(documents, text_column, rules, sample_rows)
    return _cascaded(documents, text_column, order, audit)


def quality_filter(documents: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, columns as they are."""
    report = quality_report(documents, text_column, rules)
    return keep_where(report, F.col("rejected_by").isNull()).select("row.*")
