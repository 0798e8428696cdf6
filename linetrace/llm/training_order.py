"""Token sequences in training order, written as shards of fixed stride."""

from __future__ import annotations

import base64
import glob
import json
import re
import struct
import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetrace.llm.common import send_by_value, whole
from linetrace.session import checkpointed

send_by_value(__name__)

LENGTH = 1024
KEY = 20240607
ROUNDS = 6
#: Sequences of a shard, and the shards one task writes at most.
SHARD_ROWS = 1 << 14
TASK_SHARDS = 32
#: Words, and pieces of up to ``PIECE`` characters, whose tokens a task remembers before it starts anew.
MEMORY, PIECE = 1 << 19, 64
#: Texts that are encoded together.
TEXTS = 512
#: A blank before which every word ends: what is no white space follows.
BLANK = re.compile(r"\x20(?=\S)")
TOKENS = "<u2"
#: How the sequences are written: tokens hardly repeat within small pages.
DENSE = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "parquet.page.size": str(1 << 23),
    "parquet.enable.dictionary": "false",
}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """Keyed permutation of ``0 .. count - 1``: Feistel rounds with cycle-walking.

    The rounds permute a rectangle of ``a * b >= count`` cells, at most ``a`` more
    than needed; a value outside walks on until it is inside.
    """
    if count < 2:
        return index.astype(np.int64)
    a = isqrt(count - 1) + 1
    b = -(-count // a)

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for r in range(ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64))
            if r % 2:
                right = (right + (_mixed(left.astype(np.uint64) ^ salt) % np.uint64(b)).astype(np.int64)) % b
            else:
                left = (left + (_mixed(right.astype(np.uint64) ^ salt) % np.uint64(a)).astype(np.int64)) % a
        return left * b + right

    out = step(index.astype(np.int64))
    while (outside := out >= count).any():
        out[outside] = step(out[outside])
    return out


class Tokenizer:
    """Byte-pair tokens of a public vocabulary; what stands between blanks is remembered with its tokens.

    ``path`` names a vocabulary of lines ``base64 rank`` and ``end`` the free id that ends a
    document. The pattern cuts a text into words that are encoded one by one. ``blanks`` says that
    in it a blank stands at the start of a word or among white space alone, and that white space leaves the
    blank before something else to that. Then a word begins at each blank before something else, and
    what stands from there to the next has the tokens it would get in the text.
    """

    def __init__(self, path: str, pattern: str, end: int, blanks: bool = True):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.words, self.memory, self.pieces = regex.compile(pattern), {}, {}
        self.end, self.blanks = np.array([end], TOKENS).tobytes(), blanks

    def _tokens(self, text: str) -> bytes:
        ids = self.encoding.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}H", *ids)

    def _word(self, word: str) -> bytes:
        tokens = self._tokens(word)
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        self.memory[word] = tokens
        return tokens

    def _words(self, text: str) -> bytes:
        known = self.memory.get
        return b"".join([known(w) or self._word(w) for w in self.words.findall(text)])

    def _piece(self, piece: str) -> bytes | None:
        """The tokens of a piece and the blank before it; none if the blank is one of more white space."""
        if not piece or piece[0].isspace():
            return None
        if len(piece) > PIECE:
            return self._words(" " + piece)
        if piece.isascii():  # in other texts words are those of the pattern as it is read here
            tokens = self._tokens(" " + piece)
        else:
            tokens = b"".join(map(self._tokens, self.words.findall(" " + piece)))
        if len(self.pieces) >= MEMORY:
            self.pieces.clear()
        self.pieces[piece] = tokens
        return tokens

    def encode(self, text: str) -> bytes:
        """The tokens of the whole text and the end mark, two bytes each."""
        if not self.blanks:
            return self._words(text) + self.end
        first, *others = BLANK.split(text)
        return self._words(first) + b"".join([self.pieces.get(p) or self._piece(p) for p in others]) + self.end

    def encode_all(self, texts: pa.Array) -> memoryview | bytes:
        """The tokens of the texts, each with its end mark; what stands between blanks is looked up once a call."""
        if not self.blanks or not len(texts):
            return b"".join(self.encode(text) for text in texts.to_pylist())
        split = pc.split_pattern(texts, " ")
        ends, found = split.value_lengths().to_numpy().cumsum(), split.flatten().dictionary_encode()
        firsts, number = np.concatenate([[0], ends[:-1]]), found.indices.to_numpy()
        known, names = self.pieces.get, found.dictionary.to_pylist()
        tokens = [known(p) or self._piece(p) for p in names]
        # A text with other white space at a blank is encoded by itself, as its first piece.
        odd = np.array([t is None for t in tokens])[number]
        odd[firsts] = False
        alone = np.logical_or.reduceat(odd, firsts)
        starts = [
            self.encode(texts[i].as_py())[: -len(self.end)] if alone[i] else self._words(names[number[at]])
            for i, at in enumerate(firsts)
        ]
        number = number.astype(np.int64)
        kept = np.repeat(~alone, np.diff(ends, prepend=0))
        kept[firsts] = True
        number[firsts] = len(names) + np.arange(len(firsts))
        number = np.insert(number, ends, len(names) + len(firsts))[np.insert(kept, ends, True)]
        listed = pa.array([*tokens, *starts, self.end], pa.large_binary()).take(pa.array(number))
        at = np.frombuffer(listed.buffers()[1], np.int64)[listed.offset : listed.offset + len(listed) + 1]
        return memoryview(listed.buffers()[2])[at[0] : at[-1]]


def sequences(documents: DataFrame, path: str, pattern: str, end: int, text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``(part, i, n_tokens, tokens)``: the documents as sequences of ``length`` tokens.

    Each task joins the tokens of its documents, an end mark after each, and cuts them;
    its last sequence is filled up with end marks, and ``n_tokens`` counts those before.
    Null and empty texts are an end mark alone. Documents are joined as the input's tasks hold them: another layout of
    its files gives other sequences.
    """
    stride = length * np.dtype(TOKENS).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, part = Tokenizer(path, pattern, end), TaskContext.get().partitionId()
        stream, count = bytearray(), 0

        def rows(blocks: list[bytes], sizes: list[int]) -> pa.RecordBatch:
            n = len(blocks)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(range(count, count + n), pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(blocks, pa.binary())],
                ["part", "i", "n_tokens", "tokens"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                stream += tokenizer.encode_all(batch.column(0).slice(at, TEXTS))
                if len(stream) >= stride << 6:
                    whole_blocks = len(stream) // stride
                    out = [bytes(stream[k * stride : (k + 1) * stride]) for k in range(whole_blocks)]
                    del stream[: whole_blocks * stride]
                    yield rows(out, [length] * whole_blocks)
                    count += whole_blocks
        out, sizes = [], []
        for at in range(0, len(stream), stride):
            block = bytes(stream[at : at + stride])
            sizes.append(len(block) // 2)
            out.append(block + tokenizer.end * (length - len(block) // 2))
        if out:
            yield rows(out, sizes)

    texts = documents.select(whole(F.col(f"`{text_column}`")).alias("text"))
    return texts.mapInArrow(cut, "part int, i bigint, n_tokens int, tokens binary")


def _slot(number: Column, count: int, key: int) -> Column:
    @F.pandas_udf("bigint")
    def slots(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), count, key))

    return slots(number)


def training_order(
    documents: DataFrame,
    path: str,
    pattern: str,
    end: int,
    text_column: str = "text",
    length: int = LENGTH,
    shard_rows: int = SHARD_ROWS,
    key: int = KEY,
) -> DataFrame:
    """``(shard, slot, sequence, n_tokens, tokens)``: every sequence with its global slot.

    Sequences are numbered through all tasks by prefix sums of the tasks' counts, a table of one row a task; the keyed
    permutation gives the slot, without gaps from 0. Shard k holds the slots from
    ``k * shard_rows`` on. The sequences are written once, so the numbers stay when a task is lost. Repeated rows are
    repeated; no rows give none; other columns are not looked at.
    """
    cut = checkpointed(sequences(documents, path, pattern, end, text_column, length), **DENSE)
    sizes = cut.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = checkpointed(sizes.select("part", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin")))
    n_rows = begins.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first().n
    placed = cut.join(begins, "part").withColumn("sequence", F.col("begin") + F.col("i"))
    placed = placed.withColumn("slot", _slot(F.col("sequence"), n_rows, key))
    shard = F.floor(F.col("slot") / shard_rows).cast("int").alias("shard")
    return placed.select(shard, "slot", "sequence", "n_tokens", "tokens")


def write_shards(ordered: DataFrame, folder: str, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> None:
    """Write ``shards``, ``index`` and ``meta`` below a folder of any file system Spark writes to.

    ``shards/shard=K`` holds one file: for each slot ``length`` tokens of two bytes and a byte that ends the
    record, so places are multiples of one stride. ``index`` is a table of ``shard, slot, sequence, n_tokens``.
    A task sorts and writes a range of up to ``TASK_SHARDS`` shards; its files count when it is
    complete, so a lost task is repeated. No rows write no files.
    """
    spark = ordered.sparkSession
    meta = {"length": length, "shard_rows": shard_rows, "type": TOKENS}
    index = ordered.select("shard", "slot", "sequence", "n_tokens")
    index.write.parquet(f"{folder}/index")
    shards = spark.read.schema(index.schema).parquet(f"{folder}/index").agg(F.max("shard").alias("last")).first().last
    shards = 1 if shards is None else shards + 1
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // TASK_SHARDS)))
    each = -(-shards // tasks)
    ranges = ordered.select("shard", "slot", F.col("tokens").cast("string").alias("value"))
    ranges = ranges.repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int"))
    ranges = ranges.sortWithinPartitions("shard", "slot").select("shard", "value")
    ranges.write.partitionBy("shard").option("compression", "none").option("lineSep", "\n").text(f"{folder}/shards")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{folder}/meta")


def written_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """``(shard, slot, sequence, n_tokens, tokens_crc32)`` with the CRC of what the files hold at each slot.

    A shard is read as one value. The result is empty if nothing was written.
    """
    meta = json.loads(spark.read.text(f"{folder}/meta").first().value)
    stride, per = meta["length"] * np.dtype(meta["type"]).itemsize + 1, meta["shard_rows"]
    index = spark.read.schema("shard int, slot bigint, sequence bigint, n_tokens int").parquet(f"{folder}/index")

    def crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                records = memoryview(content.as_buffer())
                found = [zlib.crc32(records[at : at + stride - 1]) for at in range(0, len(records), stride)]
                slots = shard * per + np.arange(len(found), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(found, pa.int64())], ["slot", "tokens_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    files = files.load(f"{folder}/shards").where(F.col("length") > 0)
    shard = F.regexp_extract("path", "shard=([0-9]+)/", 1).cast("bigint").alias("shard")
    found = files.select(shard, "content").mapInArrow(crcs, "slot bigint, tokens_crc32 bigint")
    return index.join(found, "slot").select("shard", "slot", "sequence", "n_tokens", "tokens_crc32")


def read_slots(folder: str, start: int, count: int) -> np.ndarray:
    """``count`` sequences from slot ``start`` on, one row each, where there are so many, from a mounted folder."""
    with open(glob.glob(f"{folder}/meta/part-*")[0]) as file:
        meta = json.load(file)
    length, per = meta["length"], meta["shard_rows"]
    stride, out = length * np.dtype(meta["type"]).itemsize + 1, []
    while count > 0:
        shard, place = divmod(start, per)
        names = glob.glob(f"{folder}/shards/shard={shard}/part-*")
        if not names:
            break
        with open(names[0], "rb") as file:
            file.seek(place * stride)
            block = np.frombuffer(file.read(min(count, per - place) * stride), np.uint8).reshape(-1, stride)
        if not len(block):
            break
        out.append(block[:, :-1].copy().view(meta["type"]))
        start, count = start + len(block), count - len(block)
    return np.concatenate(out) if out else np.empty((0, length), meta["type"])
