"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetrace.llm import (
    byte_bpe,
    conversation_repair,
    decontaminate,
    lexical_search,
    line_dedup,
    mixing,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
    training_order,
    url_filter,
)
from linetrace.llm.common import whole
from linetrace.session import checkpointed, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op4_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


@query
def op7_quality(spark, sf_dir):
    report = quality.quality_report(table(spark, sf_dir, "documents"), audit=True)
    return report.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.expr(" or ".join(f"({rule.condition})" for rule in quality.BASE_RULES)).alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


@query
def op8_mixing(spark, sf_dir):
    text = F.col("text")
    sizes = checkpointed(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            "source",
            mixing.n_words(text).alias("n_words"),
            mixing.random_key(F.col("doc_id"), F.md5(whole(text))).alias("mix_key"),
        )
    )
    mixed = mixing.mix(sizes, F.col("source"), F.col("n_words"), F.col("mix_key"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@query
def op10_sharding(spark, sf_dir):
    text = whole(F.col("text"))
    rows = checkpointed(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            (F.octet_length(text) + 16).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
    )
    placed = sharding.shuffled_shards(rows, by=("doc_id", "size", "text_crc32"))
    return placed.select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _held_out(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


@query
def op2_toxicity(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = toxicity.training_sample(documents, labels, ~_held_out("doc_id"))
    found = toxicity.scored(documents, toxicity.fit(sample))
    return found.select("doc_id", F.coalesce(_held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op5_pii(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.name = '{kind}')) as bigint)").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select(
        "row.doc_id", *counts, F.sha2(pii.span_list("base"), 256).alias("base_sha256"), pii.span_list("spans").alias("spans")
    )


#: The given rules.
URL_RULES = [
    url_filter.UrlRule("org", "/", "allow"),
    url_filter.UrlRule("example.org", "/es/", "block"),
    url_filter.UrlRule("example.org", "/en/1", "block"),
    url_filter.UrlRule("com", "/fr/", "allow"),
    url_filter.UrlRule("com", "/de/", "block"),
]


@query
def op1_url_filter(spark, sf_dir):
    found = url_filter.judged_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


#: Public vocabulary and the word pattern that belongs to it; 50256 is free in it.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50256


@query
def op6_training_order(spark, sf_dir):
    ordered = training_order.training_order(
        table(spark, sf_dir, "documents"), VOCABULARY, WORD_PATTERN, END_OF_TEXT
    )
    folder = f"{scratch_folder(spark)}/shards-{uuid.uuid4().hex}"
    training_order.write_shards(ordered, folder)
    return training_order.written_sequences(spark, folder)


@query
def op9_line_dedup(spark, sf_dir):
    found = line_dedup.line_members(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "line_no", "line_md5", "first_doc_id", "copies", "class_line", "class_doc_id"
    )


@query
def op11_byte_bpe(spark, sf_dir):
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = byte_bpe.encoded_documents(table(spark, sf_dir, "documents"), *vocabulary)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoded(F.col("ids"), vocabulary[0]), 256).alias("decoded_sha256"),
    )


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """Rows that are lost, emptied, cut off, doubled or of the wrong role, as a hash of their place says."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dice = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), dice.alias("dice"))
    copies = F.explode(F.expr("sequence(1, if(dice = 3, 2, 1))"))
    return rows.where("dice <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("dice") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("dice") == 1, "")
        .when(F.col("dice") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        copies.alias("copy"),
    )


@query
def op12_conversation_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    blocks = conversation_repair.repaired_blocks(damaged_conversations(conversations))
    report = conversation_repair.repair_report(blocks)
    every = conversations.select(F.struct(F.col("conv_id").alias("id")).alias("conv")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(report, "conv", "left").select(
        F.col("conv.id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op13_lexical_search(spark, sf_dir):
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
