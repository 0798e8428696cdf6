"""The registered queries: every operator over all version pairs of the documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetrace.functions import text as T
from linetrace.operators import align, assign, best, candidates, context, merge, positional, ranges, thin
from linetrace.plans import hybrid
from linetrace.plans.best import map_best
from linetrace.plans.hybrid import map_hybrid
from linetrace.plans.ranges import map_ranges
from linetrace.session import checkpointed, scratch_folder
from linetrace.sinks import reports
from linetrace.sources.blocks import read_lines
from linetrace.sources.documents import conversation_versions, document_versions, load, pair_votes as line_votes, version_pairs
from linetrace.sources.lines import decoded, split_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def pairs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = version_pairs(load(spark, sf_dir, "documents"))
    return pairs.select(F.col("doc_id").cast("string").alias("pair_id"))


def lines_of(spark: SparkSession, sf_dir: str, mode: str = "newline") -> DataFrame:
    """Lines of all version pairs, written once: their use is no new pairing."""
    return checkpointed(split_lines(document_versions(load(spark, sf_dir, "documents")), mode))


def pre_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.normal_lines(lines_of(spark, sf_dir))


def foreign_lines(lines: DataFrame, key: str) -> DataFrame:
    """``pair_id, side, line_no`` of the lines whose ``key`` does not occur on the other side of their pair.

    Only the numbers and a key of the text are moved.
    """
    same = Window.partitionBy("pair_id", "key")
    keyed = lines.select("pair_id", "side", "line_no", T.text_key(F.col(key)).alias("key"))
    sides = keyed.withColumn("first", F.min("side").over(same)).withColumn("last", F.max("side").over(same))
    return sides.where("first = last").select("pair_id", "side", "line_no")


def foreign_ranges(lines: DataFrame) -> DataFrame:
    """Maximal runs of foreign lines as change ranges."""
    order = Window.partitionBy("pair_id", "side").orderBy("line_no")
    runs = (
        foreign_lines(lines, "text")
        .withColumn("run", F.col("line_no") - F.row_number().over(order))
        .groupBy("pair_id", "side", "run")
        .agg((F.min("line_no") - 1).alias("start"), F.max("line_no").alias("end"))
    )
    numbered = Window.partitionBy("pair_id", "side").orderBy("start")
    return runs.select(
        "pair_id", "side", F.row_number().over(numbered).alias("range_no"), "start", "end"
    )


@query
def pair_votes(spark, sf_dir):
    """How many lines of a document have their last earlier holder in which document."""
    return line_votes(load(spark, sf_dir, "documents"))


@query
def version_lines(spark, sf_dir):
    return lines_of(spark, sf_dir)


def shaped_lines(spark: SparkSession, sf_dir: str, new: str, old: str | None = None, mode: str = "newline") -> DataFrame:
    """Lines of the version pairs after SQL over ``text`` has changed both sides."""
    versions = document_versions(load(spark, sf_dir, "documents"))
    shaped = f"case side when 'new' then {new} else {new if old is None else old} end"
    return checkpointed(split_lines(versions.withColumn("text", F.expr(shaped)), mode))


# A line and a blank line for every sentence: blank, popular and many lines.
SENTENCES = r"replace(text, '. ', '.\n\n')"
# Every line of the old side twice: lines that merge.
DOUBLED = r"regexp_replace(text, '([^\\n]+)', '$1\n$1')"
# A Unicode line separator for every comma.
SEPARATED = r"replace(text, ', ', '\u2028')"


@query
def unicode_lines(spark, sf_dir):
    return shaped_lines(spark, sf_dir, SEPARATED, mode="unicode")


@query
def long_blank_lines(spark, sf_dir):
    lines = context.normal_lines(shaped_lines(spark, sf_dir, SENTENCES))
    return lines.where("pre = ''").select("pair_id", "side", "line_no")


@query
def long_hunks(spark, sf_dir):
    return merge.hunks_with_ends(shaped_lines(spark, sf_dir, SENTENCES))


@query
def long_range_map(spark, sf_dir):
    return map_ranges(shaped_lines(spark, sf_dir, SENTENCES)).withColumn("score", F.round("score", 6))


@query
def doubled_hybrid_map(spark, sf_dir):
    return map_hybrid(shaped_lines(spark, sf_dir, "text", DOUBLED)).withColumn("score", F.round("score", 6))


@query
def replaced_bytes(spark, sf_dir):
    """Texts read as UTF-8 although they are written in another encoding."""
    content = F.encode("text", "ISO-8859-1")
    return load(spark, sf_dir, "documents").select("doc_id", decoded(content, "replace").alias("text"))


@query
def block_lines(spark, sf_dir):
    """Lines of files of a thousand documents each, written as text and read in blocks."""
    texts = load(spark, sf_dir, "documents").where("doc_id is not null").select(
        F.concat(F.lit("file"), F.expr("doc_id div 1000"), F.lit("-new")).alias("name"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    folder = f"{scratch_folder(spark)}/files-{uuid.uuid4().hex}"
    ordered = texts.repartition("name").sortWithinPartitions("name", "doc_id", "text").drop("doc_id")
    ordered.write.partitionBy("name").text(folder)
    return read_lines(spark, folder)


@query
def conversation_compare(spark, sf_dir):
    versions = conversation_versions(load(spark, sf_dir, "conversations"))
    return positional.compare_positional(split_lines(versions))


@query
def positional_compare(spark, sf_dir):
    return positional.compare_positional(lines_of(spark, sf_dir))


@query
def positional_report(spark, sf_dir):
    return reports.positional_report(positional_compare(spark, sf_dir))


@query
def normalised_lines(spark, sf_dir):
    return pre_of(spark, sf_dir)


@query
def folded_lines(spark, sf_dir):
    return lines_of(spark, sf_dir).select(
        "pair_id", "side", "line_no", T.folded_line(F.col("text")).alias("folded")
    )


@query
def blank_lines(spark, sf_dir):
    return pre_of(spark, sf_dir).where("pre = ''").select("pair_id", "side", "line_no")


@query
def struct_tokens(spark, sf_dir):
    pre = pre_of(spark, sf_dir)
    return pre.select("pair_id", "side", "line_no", T.structure_string(F.col("pre")).alias("struct_str"))


@query
def simhash_lines(spark, sf_dir):
    return context.structured(pre_of(spark, sf_dir)).select("pair_id", "side", "line_no", "simhash")


@query
def context_lines(spark, sf_dir):
    return context.context_of(pre_of(spark, sf_dir)).select("pair_id", "side", "line_no", "ctx")


@query
def range_words(spark, sf_dir):
    """The words of a line with their counts, taken where the line lies."""
    counts = F.explode(T.bag(T.words(F.col("text")))).alias("word", "n")
    words = lines_of(spark, sf_dir).select("pair_id", "side", "line_no", counts)
    return words.withColumn("n", F.col("n").cast("bigint"))


@query
def exact_blocks(spark, sf_dir):
    """Exact alignment of normal lines, no popular lines."""
    return align.exact_edges(align.hunks(pre_of(spark, sf_dir), "pre", autojunk=False))


@query
def hunks(spark, sf_dir):
    return merge.hunks_with_ends(lines_of(spark, sf_dir))


@query
def hunk_sizes(spark, sf_dir):
    sizes = merge.hunk_sizes(hunks(spark, sf_dir))
    return sizes.select("pair_id", "hunk_no", "tag", "left_lines", "right_lines", "rows")


@query
def pair_status(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    return merge.pair_status(merge.hunks_with_ends(lines), pairs_of(spark, sf_dir))


@query
def change_ranges(spark, sf_dir):
    steps = align.hunks(lines_of(spark, sf_dir), "text", autojunk=True)
    return align.change_ranges(checkpointed(steps))


@query
def unmatched_lines(spark, sf_dir):
    """Non-blank lines the exact alignment leaves on either side."""
    pre = pre_of(spark, sf_dir)
    return align.unmatched(pre.where("pre <> ''"), hybrid.exact_nonblank(pre))


@query
def range_tfidf(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    foreign = foreign_ranges(lines)
    weights = ranges.term_weights(ranges.range_lines(lines, foreign))
    return weights.withColumn("weight", F.round("weight", 6))


@query
def range_cosine(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    foreign = foreign_ranges(lines)
    weights = ranges.term_weights(ranges.range_lines(lines, foreign))
    return ranges.range_cosine(weights).withColumn("sim", F.round("sim", 6))


def _open_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Features of the foreign lines, which are marked before any line has its context."""
    pre = pre_of(spark, sf_dir)
    open_lines = foreign_lines(pre.where("pre <> ''"), "pre").withColumn("open", F.lit(True))
    marked = checkpointed(pre.join(open_lines, ["pair_id", "side", "line_no"], "left"))
    features = context.structured(context.context_of(marked).where("open").drop("open"))
    return features.where("side = 'old'"), features.where("side = 'new'")


@query
def candidate_topk(spark, sf_dir):
    return candidates.candidate_pairs(*_open_features(spark, sf_dir))


@query
def context_cosine(spark, sf_dir):
    """Context similarity of the candidates."""
    met = candidates.candidate_features(*_open_features(spark, sf_dir), ["line_no", "ctx"])
    return met.select("pair_id", "old_line", "new_line", F.round(candidates.context_similarity(), 6).alias("ctx_sim"))


@query
def candidate_scores(spark, sf_dir):
    """Combined scores of all candidates, whatever their size."""
    scored = candidates.score_candidates(*_open_features(spark, sf_dir), threshold=0.0)
    return scored.withColumn("score", F.round("score", 6))


@query
def greedy_map(spark, sf_dir):
    """Greedy one-to-one choice among the candidates of foreign lines."""
    scored = candidates.score_candidates(*_open_features(spark, sf_dir), threshold=hybrid.MATCH_SCORE)
    return assign.assign_greedy(scored, hybrid.MATCH_SCORE).withColumn("score", F.round("score", 6))


@query
def hybrid_map(spark, sf_dir):
    return map_hybrid(lines_of(spark, sf_dir)).withColumn("score", F.round("score", 6))


@query
def hybrid_report(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    mapping = checkpointed(map_hybrid(lines))
    counted = context.normal_lines(lines).where("pre <> ''")
    return reports.mapping_report(mapping, counted, empty="none", pairs=pairs_of(spark, sf_dir))


@query
def thin_map(spark, sf_dir):
    """Thinning between foreign ranges that share a token."""
    lines = lines_of(spark, sf_dir)
    foreign = foreign_ranges(lines)
    members = ranges.range_lines(lines, foreign)
    matched = ranges.range_cosine(ranges.term_weights(members))
    picked = thin.thin(thin.line_distances(matched, members, 0.4))
    return picked.withColumn("score", F.round("score", 6))


@query
def range_map(spark, sf_dir):
    return map_ranges(lines_of(spark, sf_dir)).withColumn("score", F.round("score", 6))


@query
def range_report(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    return reports.mapping_report(checkpointed(map_ranges(lines)), lines, empty="omit")


@query
def best_map(spark, sf_dir):
    lines = lines_of(spark, sf_dir, "unicode")
    return map_best(lines).withColumn("score", F.round("score", 6))


@query
def best_map_free(spark, sf_dir):
    lines = lines_of(spark, sf_dir, "unicode")
    return map_best(lines, monotone=False).withColumn("score", F.round("score", 6))


@query
def best_map_misses(spark, sf_dir):
    lines = lines_of(spark, sf_dir, "unicode")
    return map_best(lines, keep_misses=True).select("pair_id", "old_line", "new_line")


@query
def best_report(spark, sf_dir):
    lines = lines_of(spark, sf_dir, "unicode")
    return reports.mapping_report(checkpointed(map_best(lines)), lines, empty="omit")


@query
def ratio_edges(spark, sf_dir):
    """Line pairs of a ratio of at least 0.75, before any choice."""
    edges = best.ratio_edges(lines_of(spark, sf_dir, "unicode"))
    return edges.select(
        "pair_id",
        F.array_min("old_at").alias("old_line"),
        F.array_min("new_at").alias("new_line"),
        F.size("old_at").alias("old_copies"),
        F.size("new_at").alias("new_copies"),
        F.round("ratio", 6).alias("ratio"),
    )


@query
def side_by_side(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    return merge.side_by_side(lines, checkpointed(merge.hunks_with_ends(lines)))


@query
def side_by_side_changes(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    steps = checkpointed(merge.hunks_with_ends(lines))
    return merge.side_by_side(lines, steps, width=80, suppress_common=True)


def decisions_of(steps: DataFrame) -> DataFrame:
    """A decision for every differing hunk, cycling through the choices by number."""
    choices = F.array(*[F.lit(c) for c in ("l", "r", "el", "er", "eb", "ed", "e")])
    return steps.where("tag <> 'equal'").select(
        "pair_id",
        "hunk_no",
        F.get(choices, F.col("hunk_no") % 7).alias("choice"),
        F.lit(None).cast("string").alias("edited_text"),
    )


@query
def merged_text(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    steps = checkpointed(merge.hunks_with_ends(lines))
    return merge.merge(lines, steps, decisions_of(steps), pairs=pairs_of(spark, sf_dir))


@query
def dash_mapping(spark, sf_dir):
    """``i-j`` rows of the lines that equal or replace hunks set side by side."""
    steps = checkpointed(hunks(spark, sf_dir))
    return reports.mapping_rows(merge.facing_lines(steps), "dash")


@query
def ordered_report(spark, sf_dir):
    """Positional report of the pairs, mapped rows only, numbered in the order of the text."""
    steps = checkpointed(hunks(spark, sf_dir))
    report = reports.mapping_report(
        merge.facing_lines(steps), lines_of(spark, sf_dir), style="arrow", show_unmatched=False
    )
    return reports.ordered_report(report)


@query
def merge_cancelled(spark, sf_dir):
    """Merge with edited texts, a cancelling choice and hunks without a decision."""
    lines = lines_of(spark, sf_dir)
    steps = checkpointed(merge.hunks_with_ends(lines))
    choices = F.array(*[F.lit(c) for c in ("l", "r", "el", "er", "eb", "ed", "e", "q")])
    place = F.col("hunk_no") % 9
    decisions = steps.where("tag <> 'equal' and hunk_no % 9 < 8").select(
        "pair_id",
        "hunk_no",
        F.get(choices, place).alias("choice"),
        F.when(place == 2, "edited\n").alias("edited_text"),
    )
    return merge.merge(lines, steps, decisions, pairs=pairs_of(spark, sf_dir))
