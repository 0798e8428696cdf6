"""Near-duplicate documents by SimHash, found with pivot distance tables."""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetrace.llm.common import packed, send_by_value, whole
from linetrace.llm.components import connected_components
from linetrace.session import checkpointed

send_by_value(__name__)

BITS = 64
PIVOTS_PER_BLOCK = 12
PIVOT_SEED = 7
#: Keys with more fingerprints than this are linked by shared neighbours, not in pairs.
CROWD = 64
_SMALL = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: bytes, shingle: int = 3, chunk: int = 1 << 14) -> int:
    """Signed 64-bit fingerprint of a whole text; 0 where it has no word."""
    words = text.translate(_SMALL).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    total, ones = len(words) - size + 1, np.zeros(BITS, np.int64)
    for start in range(0, total, chunk):
        part = words[start : start + chunk + size - 1]
        hashes = [xxhash.xxh64_intdigest(b" ".join(t), 42) for t in zip(*(part[k:] for k in range(size)))]
        rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("bigint")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of_texts(whole(text).cast("binary"))


def _blocks(count: int) -> list[int]:
    """Masks that cut the 64 bits into ``count`` blocks."""
    edges = [round(BITS * k / count) for k in range(count + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def pivot_table(prints: DataFrame, blocks: int) -> DataFrame:
    """Add ``t0, t1, ...``: distances of ``print`` to the pivots of each block.

    A pivot is a reference fingerprint that is compared on the bits of one block;
    its distance changes by at most one with every changed bit. The distances of one
    block are packed into one number, five bits each (blocks of up to 31 bits).
    """
    draw = random.Random(PIVOT_SEED)
    for number, mask in enumerate(_blocks(blocks)):
        packed = F.lit(0).cast("bigint")
        for k in range(PIVOTS_PER_BLOCK):
            pivot = _signed(draw.getrandbits(BITS) & mask)
            inside = F.col("print").bitwiseXOR(F.lit(pivot)).bitwiseAND(F.lit(_signed(mask)))
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(inside).cast("bigint"), 5 * k))
        prints = prints.withColumn(f"t{number}", packed)
    return prints


def _close(left: str, right: str, blocks: int, limit: int) -> Column:
    """The largest difference of two rows of the pivot table is within the limit."""
    def distance(side: str, block: int, k: int) -> Column:
        return F.shiftright(F.col(f"{side}.t{block}"), 5 * k).bitwiseAND(F.lit(31).cast("bigint"))

    return F.greatest(
        *[
            F.abs(distance(left, b, k) - distance(right, b, k))
            for b in range(blocks)
            for k in range(PIVOTS_PER_BLOCK)
        ]
    ) <= F.lit(limit)


def _balls(mask: int, radius: int) -> list[int]:
    """All changes of up to ``radius`` bits of the mask."""
    bits = [1 << k for k in range(BITS) if mask >> k & 1]
    return [_signed(sum(c)) for r in range(radius + 1) for c in combinations(bits, r)]


def _crowded(keyed: DataFrame, masks: list[int], pairs: list[tuple[int, int]], limit: int) -> DataFrame:
    """Links among the many fingerprints of one key, without forming their pairs.

    Two fingerprints are within ``limit`` bits if and only if some bit string lies
    within ``limit // 2`` bits of one and ``limit - limit // 2`` of the other. Every
    such string links the fingerprints around it to one near it; as fingerprints are
    distinct, few can lie around one string.
    """
    near, far = limit // 2, limit - limit // 2
    full = (1 << BITS) - 1
    changes = F.array(
        *[
            F.array(*[F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(bin(m & full).count("1") <= near).alias("near"))
                      for m in _balls(full & ~masks[i] & ~masks[j], far)])
            for i, j in pairs
        ]
    )
    around = keyed.select("no", "print", F.explode(F.get(changes, F.col("no"))).alias("c")).select(
        "no", "print", F.col("print").bitwiseXOR(F.col("c.m")).alias("hub"), "c.near"
    )
    return (
        around.groupBy("no", "hub")
        .agg(F.min(F.when(F.col("near"), F.col("print"))).alias("a"), F.collect_set("print").alias("around"))
        .where("a is not null and size(around) > 1")
        .select("a", F.explode("around").alias("b"))
        .where("a <> b")
    )


def linked_prints(prints: DataFrame, limit: int = 2, crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)`` that join all distinct ``print`` within ``limit`` bits.

    The bits are cut into ``limit + 2`` blocks, so two fingerprints within the
    limit agree on at least two blocks and hence on the pivot distances there, which makes an
    equality key for each choice of two blocks. Rows that share a key are discarded when any
    pivot distance differs by more than the limit, and the rest verified bit by
    bit. Keys with over ``crowd`` fingerprints take ``_crowded``, which is exact too.
    The pairs that are not listed are those within one crowd; they are joined by a
    path of listed links.
    """
    blocks = max(limit + 2, 3)
    masks, pairs = _blocks(blocks), list(combinations(range(blocks), 2))
    columns = [f"t{b}" for b in range(blocks)]
    keys = F.array(*[F.struct(F.lit(n).alias("no"), F.xxhash64(F.lit(n), f"t{i}", f"t{j}").alias("key")) for n, (i, j) in enumerate(pairs)])
    keyed = pivot_table(prints.select("print"), blocks).select("print", *columns, F.explode(keys).alias("k"))
    keyed = keyed.select("print", *columns, "k.no", "k.key")
    sizes = keyed.groupBy("no", "key").agg(F.count("*").alias("size")).where("size > 1")
    shared = checkpointed(keyed.join(sizes, ["no", "key"]))
    few = shared.where(F.col("size") <= crowd)
    found = (
        few.alias("x")
        .join(
            few.alias("y"),
            (F.col("x.no") == F.col("y.no"))
            & (F.col("x.key") == F.col("y.key"))
            & (F.col("x.print") < F.col("y.print"))
            & _close("x", "y", blocks, limit)
            & (F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print"))) <= limit),
        )
        .select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))
    )
    return found.union(_crowded(shared.where(F.col("size") > crowd), masks, pairs, limit))


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    limit: int = 2,
) -> DataFrame:
    """``(doc_id, print, component_id)`` of every row of the documents.

    ``print`` is the SimHash of the ``shingle``-word shingles of the whole text, as
    bigint; fingerprints within ``limit`` bits are linked, and ``component_id`` is the
    smallest id that can be reached. Null and word-less texts have fingerprint 0 and
    are linked like others; a text with fewer words is one shingle. Repeated rows stay
    rows. Rows with a null id are linked too; a component of such rows alone
    has a null component. Other columns are not looked at; an empty table gives none.
    """
    rows = _fingerprints(documents, id_column, text_column, shingle)
    member = _rooted(rows, limit)
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = member.join(least, "root").select("print", "component_id")
    return rows.join(placed, "print").select("doc_id", "print", "component_id")


def _fingerprints(documents: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    return checkpointed(
        documents.select(F.col(f"`{id_column}`").alias("doc_id"), fingerprint(F.col(f"`{text_column}`"), shingle).alias("print"))
    )


def _rooted(rows: DataFrame, limit: int) -> DataFrame:
    """``(print, least, named, root)`` of each fingerprint: its least id, whether it has one, its component's name."""
    classes = checkpointed(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = connected_components(linked_prints(classes, limit)).withColumnRenamed("node", "print")
    return classes.join(roots, "print", "left").select(
        "print", "least", F.isnotnull("least").alias("named"), F.coalesce("root", "print").alias("root")
    )


def without_near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3, limit: int = 2
) -> DataFrame:
    """The documents with one row of each component left, columns as they are.

    The row with the smallest id stays, null last. Where that id has several rows in the component, the
    smallest fingerprint decides, then the least MD5 of the text; rows that are equal in
    these are interchangeable in text, and one of them stays. Rows with one id in different
    components are judged apart, so no text is lost without a near copy that stays. Null and
    word-less texts are copies of each other. An empty table stays empty.
    """
    rows = _fingerprints(documents, id_column, text_column, shingle)
    first = F.min(F.struct((~F.col("named")).alias("nameless"), F.col("least").alias("doc_id"), "print")).alias("first")
    chosen = checkpointed(_rooted(rows, limit).groupBy("root").agg(first).select("first.doc_id", "first.print"))
    several = checkpointed(rows.groupBy("doc_id").count().where("doc_id is null or count > 1").select("doc_id"))
    same = lambda x, y: F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id"))
    gone = rows.alias("r").join(
        chosen.alias("c"), same("r", "c") & (F.col("r.print") == F.col("c.print")), "left_anti"
    )
    ids = F.col(f"`{id_column}`")
    # Most ids stand on one row: what goes is named by its id, without another look at the text.
    gone = checkpointed(gone.where("doc_id is not null").select(F.col("doc_id").alias("gone_id")).distinct())
    named = documents.where(ids.isNotNull())
    if several.isEmpty():
        return named.join(gone, ids == F.col("gone_id"), "left_anti")
    listed = several.where("doc_id is not null").select(F.col("doc_id").alias("several_id"))
    kept = named.join(gone, ids == F.col("gone_id"), "left_anti").join(listed, ids == F.col("several_id"), "left_anti")
    text = F.col(f"`{text_column}`")
    again = named.join(listed, ids == F.col("several_id"), "left_semi").unionByName(documents.where(ids.isNull()))
    again = packed(again, doc_id=ids, print=fingerprint(text, shingle), name=F.md5(whole(text)))
    best = Window.partitionBy("r.doc_id", "r.print").orderBy("r.name")
    again = again.alias("r").join(chosen.alias("c"), same("r", "c") & (F.col("r.print") == F.col("c.print")))
    again = again.select("r.row", F.row_number().over(best).alias("place")).where("place = 1")
    return kept.unionByName(again.select("row.*"))
