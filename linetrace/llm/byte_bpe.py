"""Byte-level BPE by longest matches and backtracking; encoding and decoding."""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linetrace.llm.common import send_by_value, whole

send_by_value(__name__)

#: Token ids are stored as little-endian unsigned 32-bit integers.
IDS = "<u4"
#: Pairs and words a worker remembers before it starts anew; longer words are not remembered.
PAIRS, WORDS, WORD_BYTES = 1 << 20, 1 << 18, 48
#: Characters of a long text.
LONG = 1 << 20


def read_ranks(path: str) -> dict[str, int]:
    """The vocabulary of lines ``base64 rank``; bytes are mapped to Latin-1 characters."""
    with open(path, "rb") as file:
        return {base64.b64decode(word).decode("latin-1"): int(rank) for word, rank in map(bytes.split, file)}


def halves(token: str, ranks: dict[str, int]) -> tuple[str, str] | None:
    """The two tokens whose merge is the last one on the way to this token.

    Merges the characters by rank until two pieces are left; ``None`` when the
    merges do not come to that, so that only a whole word can be this token.
    """
    pieces = list(token)
    while len(pieces) > 2:
        joined = [ranks.get(x + y) for x, y in zip(pieces, pieces[1:])]
        least = min((r for r in joined if r is not None), default=None)
        if least is None:
            return None
        if least >= ranks[token]:
            raise ValueError("a token ranks before its parts: no list of merges")
        at = joined.index(least)
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
    return pieces[0], pieces[1]


class Vocabulary:
    """Encodes words into the tokens that merging by rank gives, in linear time.

    An automaton over the reversed tokens reads a word from its end and finds the longest token that
    starts at each byte. The encoder takes these from the left. Two neighbours are
    compatible if merging their bytes alone gives the two again; a word whose neighbours
    are all compatible is encoded as the merges would. A token that does not fit its
    left neighbour gives way to the next shorter one, and without any the neighbour
    itself is taken back; the place is then marked and never tried again.
    """

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.text = {rank: token for token, rank in ranks.items()}
        if missing := [b for b in range(256) if chr(b) not in ranks]:
            raise ValueError(f"{len(missing)} bytes have no token")
        self.halves, self.merged, self.shorter = {}, {}, {}
        # When a token comes into being: bytes are there from the start.
        self.born = dict.fromkeys(self.text, -1)
        reverse = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) > 1:
                if (two := halves(token, ranks)) is None:
                    continue
                left, right = ranks[two[0]], ranks[two[1]]
                self.halves[rank], self.merged[left, right], self.born[rank] = (left, right), rank, rank
            reverse.add_word(token[::-1], rank)
        for rank in [*self.halves, *(ranks[chr(b)] for b in range(256))]:
            token = self.text[rank]
            prefixes = (ranks.get(token[:k]) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p in self.halves or p is not None and self.born[p] < 0), None)
        reverse.make_automaton()
        self.reverse = reverse
        self.size = {rank: len(token) for rank, token in self.text.items()}
        self.end = max(self.text) + 1
        self.pairs: dict[tuple[int, int], bool] = {}

    def fits(self, left: int, right: int) -> bool:
        """Merging the bytes of both by rank gives exactly these two tokens.

        The merges inside both are undone from the latest to the earliest. What stands on
        both sides of the border then stood there until the merge undone last; had the
        two a merge of an earlier rank, it would have crossed the border. Equal ranks go
        from left to right, so the border wins against the right token only.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        before = self.end
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                return False
            if self.born[left] > self.born[right]:
                before, left = left, self.halves[left][1]
            elif self.born[right] >= 0:
                before, right = right + 1, self.halves[right][0]
            else:
                return True

    def encode(self, word: str) -> list[int]:
        """Token ids of one word, given as Latin-1 characters for its bytes."""
        if not word:
            return []
        if (alone := self.ranks.get(word)) is not None:
            return [alone]
        # The first match that ends at a place is its longest, so it is put in last.
        longest = dict(reversed(list(self.reverse.iter(word[::-1]))))
        size, shorter, known, fits = self.size, self.shorter, self.pairs.get, self.fits
        last, at, left, tokens, closed = len(word) - 1, 0, None, [], set()
        token = longest[last]
        while True:
            while token is not None:
                if not closed or at + size[token] not in closed:
                    if left is None or (known((left, token)) or fits(left, token)):
                        break
                token = shorter[token]
            if token is None:
                closed.add(at)
                token = tokens.pop()
                at -= size[token]
            else:
                tokens.append(token)
                at += size[token]
                if at > last:
                    return tokens
                token = longest[last - at]
            left = tokens[-1] if tokens else None


class Encoder:
    """Texts to ids, with the words of a pattern encoded one by one."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(read_ranks(path))
        self.words = regex.compile(pattern)
        self.memory: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        data = word.encode()
        ids = array("I", self.vocabulary.encode(data.decode("latin-1")))
        if sys.byteorder == "big":
            ids.byteswap()
        ids = ids.tobytes()
        if len(data) <= WORD_BYTES:
            if len(self.memory) >= WORDS:
                self.memory.clear()
            self.memory[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        known = self.memory.get
        # The words of a long text are not held all at once.
        words = self.words.findall(text) if len(text) < LONG else map(regex.Match.group, self.words.finditer(text))
        return b"".join([known(w) or self._word(w) for w in words])


class Decoder:
    """Ids to bytes."""

    def __init__(self, path: str):
        self.bytes = {rank: token.encode("latin-1") for token, rank in read_ranks(path).items()}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, IDS).tolist()))


def _kept(kind: type, *arguments: str):
    """One object for each Python worker and its arguments, kept from task to task.

    Functions travel by value, so that globals of this module are new in every task; what
    a worker keeps is a module of its own.
    """
    store = sys.modules.setdefault("byte_bpe_of_this_worker", ModuleType("byte_bpe_of_this_worker")).__dict__
    name = " ".join((kind.__name__, *arguments))
    if name not in store:
        store[name] = kind(*arguments)
    return store[name]


def decoded(ids: Column, path: str) -> Column:
    """The bytes that the ids stand for; null for null. An id outside the vocabulary is an error."""

    @F.arrow_udf("binary")
    def data(rows: pa.Array) -> pa.Array:
        decode = _kept(Decoder, path).decode
        return pa.array([None if r is None else decode(r) for r in (x.as_py() for x in rows)], pa.binary())

    return data(ids)


def encoded_documents(
    documents: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, ids)``: the ids of every whole text as binary, four little-endian bytes each.

    ``path`` names a vocabulary file that every machine has. What the pattern does not match
    is left out, as in other libraries. A null text has no ids, like an empty one. Rows are
    encoded one by one, so null ids and repeated rows stay as they are; other columns are not
    looked at, and an empty table gives none.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(Encoder, path, pattern)
        for batch in batches:
            ids = pa.array([encoder.encode(text.as_py()) for text in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    texts = documents.select(
        F.col(f"`{id_column}`").alias("doc_id"), whole(F.col(f"`{text_column}`")).alias("text")
    )
    schema = T.StructType([texts.schema["doc_id"], T.StructField("ids", T.BinaryType())])
    return texts.mapInArrow(encode, schema)
