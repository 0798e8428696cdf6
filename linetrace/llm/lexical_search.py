"""Ranked lexical search: documents grouped by the query terms they hold."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linetrace.llm.common import packed, send_by_value, whole
from linetrace.session import checkpointed

send_by_value(__name__)

TOP = 10
#: Terms of the queries that are searched at once; a query with more is searched alone.
BLOCK_TERMS = 1 << 18
#: Documents whose bitmaps a task holds at once.
BLOCK_DOCUMENTS = 10_000
#: Documents judged at once at first; their number doubles.
CHUNK = 128
#: Groups that the candidates of a query are dealt to before they meet in one.
GROUPS = 64

#: Bytes of terms, ``A-Z`` made small; all others separate.
_BYTES = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and of all characters beyond ASCII, ``A-Z`` in small letters."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split(b" ")


def _count_terms(text: str) -> Counter:
    found = Counter(terms(text))
    found.pop(b"", None)
    return found


def _text(column: pa.Array, at: int) -> str:
    return column[at].as_py() or ""


def query_terms(queries: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(query, item_id, terms)``: each query with a number of its own and its terms, once each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(_count_terms(_text(batch.column(1), k))) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    texts = queries.select(F.col(f"`{id_column}`").alias("item_id"), F.col(f"`{text_column}`").alias("text"))
    schema = T.StructType([texts.schema["item_id"], T.StructField("terms", T.ArrayType(T.BinaryType()))])
    return texts.mapInArrow(cut, schema).select(F.monotonically_increasing_id().alias("query"), "item_id", "terms")


def query_blocks(queries: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges ``first, last`` of query numbers with at most ``most`` terms together, or one query.

    Sums over runs of numbers come to the driver: one for each 4,096 queries, each cut again only where
    it is needed.
    """
    sums = queries.groupBy(F.expr("query div 4096").alias("run")).agg(F.sum(F.size("terms")).alias("n")).orderBy("run")
    blocks, total = [], 0
    for run, n in sums.collect():
        parts = [(run * 4096, run * 4096 + 4095, n)]
        if n > most:
            inside = queries.where(F.col("query").between(run * 4096, run * 4096 + 4095))
            parts = [(q, q, k) for q, k in inside.select("query", F.size("terms")).orderBy("query").collect()]
        for first, last, k in parts:
            if blocks and total + k <= most:
                blocks[-1], total = (blocks[-1][0], last), total + k
            else:
                blocks.append((first, last))
                total = k
    return blocks


def term_index(documents: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """``(doc_id, n, terms, tf)`` of the documents with a term: the numbered terms and how often each occurs.

    ``n`` counts all terms of the document, repeats included; only those of the vocabulary are listed.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            counts, listed, often = [], [], []
            for k in range(batch.num_rows):
                found = _count_terms(_text(batch.column(1), k))
                counts.append(sum(found.values()))
                hits = [(i, c) for t, c in found.items() if (i := number(t)) is not None]
                listed.append([i for i, _ in hits])
                often.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(listed, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tf"],
            )

    texts = documents.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    fields = [T.StructField("n", T.LongType()), *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("terms", "tf")]]
    return texts.mapInArrow(index, T.StructType([texts.schema["doc_id"], *fields])).where("n > 0")


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1000000000 * tf) // (1000 * tf + 8 * m)


class Block:
    """Documents with their counts of query terms, and a bitmap of the documents for every term."""

    def __init__(self, ids: list, n: np.ndarray, term: np.ndarray, tf: np.ndarray, doc: np.ndarray, norm: tuple[int, int]):
        total, length = norm
        self.ids, self.m = ids, 10 + (90 * n * total) // length
        order = np.lexsort((doc, term))
        self.doc, self.tf, term = doc[order], tf[order], term[order]
        self.terms, starts = np.unique(term, return_index=True)
        self.bounds = dict(zip(self.terms.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(term)])))
        # No document of the block has more from a term than its most occurrences in the shortest document give.
        least = self.m.min() if len(n) else 10
        self.most = {t: int(_impact(self.tf[a:b].max(), least)) for t, (a, b) in self.bounds.items()}

    def best(self, wanted: list[tuple[int, int]], top: list, size: int) -> None:
        """Put the block's best documents for the terms ``(number, weight)`` into the heap ``top``.

        Bitmaps of the matched terms give each document its mask; documents of one mask are
        judged together, masks in descending order of the most they can score, until no
        further mask can reach the worst of a full heap. Masks of few documents are
        taken several at a time.
        """
        present = [(t, w) for t, w in wanted if t in self.bounds]
        masks = np.zeros((-(-len(present) // 64), len(self.m)), np.uint64)
        reach = np.zeros(len(self.m), np.int64)
        for row, (t, w) in enumerate(present):
            a, b = self.bounds[t]
            masks[row >> 6, self.doc[a:b]] |= np.uint64(1 << (row & 63))
            reach[self.doc[a:b]] += w * self.most[t]
        docs = np.flatnonzero(reach)
        if not len(docs):
            return
        first, member = _groups(masks[:, docs])
        place = np.empty(len(first), np.int64)
        place[np.argsort(-reach[docs[first]], kind="stable")] = np.arange(len(first))
        group = place[member]
        order = np.argsort(group, kind="stable")
        docs, ends = docs[order], np.cumsum(np.bincount(group))
        at, step = 0, CHUNK
        while at < len(docs) and (len(top) < size or reach[docs[at]] >= top[0][0]):
            end = int(ends[np.searchsorted(ends, min(at + step, len(docs)))])
            self._judge(docs[at:end], present, top, size)
            at, step = end, 2 * step

    def _judge(self, docs: np.ndarray, present: list[tuple[int, int]], top: list, size: int) -> None:
        score = np.zeros(len(docs), np.int64)
        for t, w in present:
            a, b = self.bounds[t]
            place = np.minimum(np.searchsorted(self.doc[a:b], docs), b - a - 1) + a
            hit = np.flatnonzero(self.doc[place] == docs)
            score[hit] += w * _impact(self.tf[place[hit]], self.m[docs[hit]])
        worst = np.partition(score, -size)[-size] if len(score) > size else 0
        for k in np.flatnonzero(score >= worst).tolist():
            _offer(top, size, int(score[k]), self.ids[docs[k]])


def _groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document of each different mask, and the number of every document's mask.

    Masks are columns of 64-bit words, refined word by word.
    """
    _, first, member = np.unique(masks[0], return_index=True, return_inverse=True)
    for words in masks[1:]:
        _, inside = np.unique(words, return_inverse=True)
        _, first, member = np.unique(member * (inside.max() + 1) + inside, return_index=True, return_inverse=True)
    return first, member


class _Last:
    """An id that sorts the other way round, null before all."""

    __slots__ = ("id",)

    def __init__(self, id_):
        self.id = id_

    def __lt__(self, other: _Last) -> bool:
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return other.id < self.id


def _offer(top: list, size: int, score: int, id_) -> None:
    """Keep the highest scores in the heap, of equal ones the least ids, null last."""
    if score <= 0 or len(top) == size and score < top[0][0]:
        return
    entry = (score, _Last(id_))
    if len(top) < size:
        heapq.heappush(top, entry)
    elif top[0] < entry:
        heapq.heapreplace(top, entry)


def _search(index: DataFrame, queries: list[tuple[int, list[tuple[int, int]]]], norm: tuple[int, int], size: int, rows: int) -> DataFrame:
    """``(query, doc_id, score)``: the best of every task for each query."""
    kind = index.schema["doc_id"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list] = [[] for _ in queries]
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                listed, often = part.column(2), part.column(3)
                sizes = np.diff(listed.offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), sizes)
                term = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = often.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                block = Block(part.column(0).to_pylist(), part.column(1).to_numpy(), term, tf, doc, norm)
                for top, (_, wanted) in zip(tops, queries):
                    block.best(wanted, top, size)
        found = [(q, e[1].id, e[0]) for (q, _), top in zip(queries, tops) for e in top]
        columns = list(zip(*found)) or [(), (), ()]
        arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], doc_type), pa.array(columns[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(kind.dataType)
    schema = T.StructType([T.StructField("query", T.LongType()), kind, T.StructField("score", T.LongType())])
    return index.mapInArrow(search, schema)


def _best(found: DataFrame, size: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def ranked_search(
    documents: DataFrame,
    queries: DataFrame,
    query_id: str = "item_id",
    query_text: str = "text",
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = TOP,
    block_terms: int = BLOCK_TERMS,
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``size`` best documents for each row of the queries.

    With N documents that hold a term, L terms in all of them, n in one, df documents with a
    term and tf occurrences in one: a term weighs ``floor(1000 ln((2N + 2) / (2df + 1)))``, m is
    ``10 + (90 n N) div L``, and a score sums ``weight * (10^9 tf) div (1000 tf + 8 m)`` over the
    query's different terms. Scores of 0 are left out; equal scores go by ascending id, null last.

    Null and empty texts hold no term; a query without one has no rows, and neither has one against an
    empty table. Rows with one id, of queries and of documents, count as rows of their own. Columns
    beyond the named are not looked at.

    The documents are read once for each block of queries, which is bounded by its terms. Every
    task returns its own best; they meet in ``GROUPS`` groups a query first.
    """
    numbered = checkpointed(query_terms(queries, query_id, query_text))
    found = []
    for first, last in query_blocks(numbered, block_terms):
        rows = numbered.where(F.col("query").between(first, last)).select("query", "terms").collect()
        vocabulary = {t: k for k, t in enumerate(sorted({bytes(t) for row in rows for t in row.terms}))}
        index = checkpointed(term_index(documents, vocabulary, id_column, text_column))
        total, length = index.agg(F.count("*"), F.sum("n")).first()
        if not total:
            continue
        weight = F.floor(1000 * F.log(F.lit(2.0 * total + 2) / (2 * F.col("df") + 1)))
        frequent = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weights = dict(frequent.select("term", weight.alias("w")).where("w > 0").collect())
        wanted = []
        for row in rows:
            numbers = (vocabulary[bytes(t)] for t in row.terms)
            if listed := [(k, weights[k]) for k in numbers if k in weights]:
                wanted.append((row["query"], listed))
        found.append(_search(index, wanted, (total, length), size, block_documents))
    if not found:
        ids = documents.select(F.col(f"`{id_column}`").alias("doc_id")).schema
        rank, score = T.StructField("rank", T.IntegerType()), T.StructField("score", T.LongType())
        return documents.sparkSession.createDataFrame([], T.StructType([numbered.schema["item_id"], rank, *ids, score]))
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    dealt = checkpointed(candidates).withColumn("group", F.pmod(F.xxhash64("doc_id", "score"), F.lit(GROUPS)))
    best = _best(_best(dealt, size, "query", "group").drop("rank"), size, "query")
    return best.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
