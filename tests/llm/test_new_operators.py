"""Byte-level BPE, conversation repair and lexical search against plain loops, on odd rows."""

import base64
import hashlib
import os
import random
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import plain  # noqa: E402
from test_operators import SCHEMA, items, none, odd, odd_rows, odd_texts, repeated  # noqa: E402, F401

from linetrace.llm import byte_bpe, conversation_repair, lexical_search, queries, training_order  # noqa: E402
from linetrace.llm.byte_bpe import IDS  # noqa: E402

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(VOCABULARY[0], "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=VOCABULARY[1], mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(*VOCABULARY)


def test_encoding_of_odd_rows(repeated, none, library):
    found = byte_bpe.encoded_documents(repeated, *VOCABULARY)
    rows = found.select("doc_id", "ids", byte_bpe.decoded(F.col("ids"), VOCABULARY[0]).alias("back")).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), bytes(r.back)) for r in rows)
    want = []
    for doc, text in repeated.select("doc_id", "text").collect():
        ids = np.array(library.encode_ordinary(text or ""), IDS).tobytes()
        want.append((doc is None, doc or 0, ids, (text or "").encode()))
    assert got == sorted(want)
    assert byte_bpe.encoded_documents(none, *VOCABULARY).count() == 0


def test_encoding_of_random_texts(encoder, library):
    rng, decode = random.Random(1), byte_bpe.Decoder(VOCABULARY[0]).decode
    pieces = [t.encode("latin-1").decode("utf-8", "ignore") for t in encoder.vocabulary.ranks]
    for kind in range(4000):
        if kind % 2:
            text = "".join(rng.choice("ab cdeé \n\t12!?-好'sll") for _ in range(rng.randrange(60)))
        else:
            text = "".join(rng.choice(pieces).strip() for _ in range(rng.randrange(7)))
        ids = encoder.encode(text)
        assert np.frombuffer(ids, IDS).tolist() == library.encode_ordinary(text)
        assert decode(ids) == text.encode()


def test_long_words_take_linear_time(encoder, library):
    rng = random.Random(2)
    for word in ("a" * 300_000, "".join(rng.choice("abcdefgh") for _ in range(100_000)), "-=" * 50_000):
        assert np.frombuffer(encoder.encode(word), IDS).tolist() == library.encode_ordinary(word)


def test_tokens_out_of_reach_are_found_as_whole_words_only():
    ranks = {chr(b): b for b in range(256)} | {"ab": 256, "bc": 257, "abcd": 258}
    vocabulary = byte_bpe.Vocabulary(ranks)
    assert vocabulary.encode("abcd") == [258]
    assert vocabulary.encode("abcda") == [256, ord("c"), ord("d"), ord("a")]
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({"a": 0})
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({chr(b): b for b in range(256)} | {"abc": 256, "ab": 257, "abcab": 258, "abab": 259})


def talk(rng, count, longest, null=True):
    rows, texts = [], ["One.", "Two", "three!", " ", "", "four?", "five. ", "six.\n", "seven\n", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "umbrella", ""]
    for conv in range(count):
        for turn in range(rng.randrange(1, longest)):
            kept = None if null and rng.random() < 0.1 else turn + rng.randrange(2)
            rows.append((conv if conv else None, kept, rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"Text {turn}."))
    return rows


TALK = "conv_id bigint, turn bigint, role string, text string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha")


@pytest.mark.parametrize("block, fan, longest", [(512, 4096, 12), (3, 2, 30), (1, 3, 20)])
def test_repair_equals_trying_all_edits(spark, block, fan, longest):
    rows = talk(random.Random(block), 60, longest)
    rng = random.Random(7)
    for role in ("tool", "user", "assistant"):
        rows += [(900 + len(role), k, role, f"Same {k}.") for k in range(40)]
    rows += [(990, 5, "user", "The same text.")] * 50 + [(991, None, None, None)] * 9
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, TALK).repartition(3)
    blocks = conversation_repair.repaired_blocks(frame, block=block, fan=fan)
    got = {r.conv.id: tuple(r[c] for c in COUNTS) for r in conversation_repair.repair_report(blocks).collect()}
    want = plain.repaired(rows)
    assert got == want
    texts = conversation_repair.repaired_rows(blocks).orderBy("conv", "block", "place").collect()
    by_conv = {}
    for r in texts:
        by_conv.setdefault(r.conv.id, []).append(f"{r.role}:{r.text}")
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(by_conv.get(conv, [])).encode()).hexdigest() == row[-1]


def test_repair_survivors_keep_undecided_edits_only():
    survivors, decided, most = conversation_repair.Survivors(), 0, 0
    rng = random.Random(4)
    for _ in range(5000):
        decided += len(survivors.feed(rng.choice("sssuuuaaaoUA-")))
        most = max(most, max(len(survivors.undecided(node)) for _, node in survivors.alive.values()))
    assert decided + most >= 5000 and most < 200


def test_repair_of_empty_and_clashing_tables(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi.", 9, "x")], TALK + ", block int, `role.x` string")
    report = conversation_repair.repair_report(conversation_repair.repaired_blocks(frame)).collect()
    assert [(r.conv.id, r.cost, r.audit) for r in report] == [(1, 2, "D")]
    none = conversation_repair.repaired_blocks(frame.where("turn > 5"))
    assert conversation_repair.repair_report(none).count() == 0


def test_damage_and_repair_query(spark, tmp_path):
    rows = talk(random.Random(11), 200, 9)
    spark.createDataFrame(rows, TALK).write.parquet(str(tmp_path / "conversations.parquet"))
    import zlib

    damaged = []
    for conv, turn, role, text in rows:
        dice = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        if dice == 1:
            text = ""
        elif dice == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        damaged += [(conv, turn, "user" if dice == 4 else role, text)] * (0 if dice == 0 else 2 if dice == 3 else 1)
    want = plain.repaired(damaged)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {tuple(r[n] for n in names) for r in got} == {(c, *want.get(c, nothing)) for c in {r[0] for r in rows}}
    assert len(got) == len({r[0] for r in rows})


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("block_terms, block_documents", [(1 << 18, 10_000), (5, 4)])
def test_search_equals_scoring_all(repeated, items, block_terms, block_documents):  # noqa: F811
    documents = [(r.doc_id, r.text) for r in repeated.select("doc_id", "text").collect()]
    listed = [(r[0], r[1]) for r in items.select("item_id", "text").collect()]
    found = lexical_search.ranked_search(repeated, items, block_terms=block_terms, block_documents=block_documents)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(tuple(r) for r in found.collect()) == order(plain.ranked(documents, listed))


def test_search_of_long_queries(spark):
    """More than 64 terms: masks of several words; many equal scores."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    documents = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 90)))) for k in range(200)] + [(k, "w1 w2") for k in range(200, 240)]
    queries_ = [(k, " ".join(rng.sample(words, n))) for k, n in enumerate((1, 2, 63, 64, 65, 200, 300))]
    found = lexical_search.ranked_search(
        spark.createDataFrame(documents, "doc_id bigint, text string").repartition(4),
        spark.createDataFrame(queries_, "item_id bigint, text string"), block_documents=37,
    )
    assert order(tuple(r) for r in found.collect()) == order(plain.ranked(documents, queries_))


def test_search_of_empty_tables(odd, none, items):  # noqa: F811
    assert lexical_search.ranked_search(none, items).count() == 0
    assert lexical_search.ranked_search(odd, items.where("item_id < 0")).count() == 0


def test_training_order_looks_words_up_once():
    """Texts encoded together have the tokens of their words, whatever white space lies between; equal words are one call."""
    rng = random.Random(11)
    parts = [" ", "  ", "\n", "\t", "a", "é", "7", ".", "'s", "\x1c", "\x85", "\xa0", "\u3000", "²", "漢", " ab", " cd", "x" * 70]
    tokenizer = training_order.Tokenizer(queries.VOCABULARY, queries.WORD_PATTERN, queries.END_OF_TEXT)
    plainly = training_order.Tokenizer(queries.VOCABULARY, queries.WORD_PATTERN, queries.END_OF_TEXT, blanks=False)
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(9))]
        expected = [plainly.encode(text) for text in texts]
        assert bytes(tokenizer.encode_all(pa.array(texts, pa.string()))) == b"".join(expected)
        assert [tokenizer.encode(text) for text in texts] == expected
    calls = []
    tokenizer._tokens = lambda text, tokens=tokenizer._tokens: calls.append(text) or tokens(text)
    tokenizer.encode_all(pa.array(["so new, so new, so new,"] * 50))
    assert sorted(calls) == [" new,", " so", "so"]
