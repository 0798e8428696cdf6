"""Exact alignment: longest common blocks of lines, taken recursively.

In every region (at first a whole pair) the longest run of equal lines is a block;
among equal lengths the first in the old version, then the first in the new one.
What lies left and right of it are new regions. All regions of all pairs are cut
at the same time, by joins and windows:

* Equal neighbours are one element with a length. Elements of both versions that are equal are
  joined; such a rectangle of equal lines is one piece for each of its diagonals, and pieces that
  touch on a diagonal are a run. So runs are as many as lines, also where one line is repeated.
* A round takes the longest runs of every region, the first one, the first one after it and so on:
  no longer one can lie between them. The other runs are shorter than these blocks, so
  each keeps at most one part between two of them. Every round lessens the greatest
  length in all regions, so rounds are as many as different lengths.
* Where lines repeat so often that joining them would grow faster than the region, windows of
  2, 4, 8, ... lines are named by hashes, each from two of half the length. The longest
  windows that both versions hold are joined instead of lines. What they leave are smaller regions
  without a window of that length in common, which are looked at again.
* Pairs of up to ``FOLD`` lines and as many joined ones need no rounds: their runs are found in one stage, dealt out
  by pair, and cut in one row a pair. Rounds and windows are for the larger pairs.

Positions are 0-based here, intervals half-open.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linetrace.session import checkpointed, spread

#: Lines of a pair, and joined ones, up to which its runs are cut in one row.
FOLD = 1 << 17
#: Joined elements for each line of a region, above which windows of lines are joined instead.
REPEAT_FACTOR = 8
#: Windows have up to two to this power lines; a longer run is made of several.
LEVELS = 20

REGION = ["pair_id", "region"]

# A line is popular when the new version has at least this many
# lines and the line is more than one in a hundred of them, plus one.
POPULAR_MIN_LINES = 200
POPULAR_SHARE = 100


def _keys(lines: DataFrame, key: Column) -> DataFrame:
    return lines.select(
        "pair_id", "side", (F.col("line_no") - 1).alias("pos"), F.xxhash64(key).alias("key")
    )


def pair_sizes(keys: DataFrame) -> DataFrame:
    return keys.groupBy("pair_id").agg(
        F.count_if(F.col("side") == "old").cast("int").alias("n_old"),
        F.count_if(F.col("side") == "new").cast("int").alias("n_new"),
    )


def _with_popular(keys: DataFrame, sizes: DataFrame, autojunk: bool) -> DataFrame:
    """Flag lines that may extend a block but not start one."""
    if not autojunk:
        return keys.withColumn("popular", F.lit(False))
    long_pairs = sizes.where(F.col("n_new") >= POPULAR_MIN_LINES).select("pair_id", "n_new")
    popular = (
        keys.where("side = 'new'")
        .join(long_pairs, "pair_id")
        .groupBy("pair_id", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.first("n_new").alias("n_new"))
        .where(F.col("n") > F.floor(F.col("n_new") / POPULAR_SHARE) + 1)
        .select("pair_id", "key", F.lit(True).alias("flag"))
    )
    return keys.join(popular, ["pair_id", "key"], "left").select(
        "pair_id", "side", "pos", "key", F.coalesce("flag", F.lit(False)).alias("popular")
    )


def _elements(positions: DataFrame) -> DataFrame:
    """Equal neighbours as one: ``pair_id, region, side, key, start, size``, from ``... pos, key``."""
    order = Window.partitionBy(*REGION, "side").orderBy("pos")
    new = (F.lag("pos").over(order) + 1 != F.col("pos")) | (F.lag("key").over(order) != F.col("key"))
    return (
        positions.withColumn("new", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0))
        .withColumn("element", F.sum("new").over(order))
        .groupBy(*REGION, "side", "element")
        .agg(F.first("key").alias("key"), F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("size"))
        .drop("element")
    )


def _often_repeated(elements: DataFrame, factor: int) -> DataFrame:
    """Regions where joining equal elements gives more than ``factor`` times the lines."""
    per_key = elements.groupBy(*REGION, "key").agg(
        F.count_if(F.col("side") == "old").alias("a"),
        F.count_if(F.col("side") == "new").alias("b"),
        F.sum("size").alias("lines"),
    )
    sums = per_key.groupBy(*REGION).agg(F.sum(F.col("a") * F.col("b")).alias("joined"), F.sum("lines").alias("lines"))
    return sums.where(F.col("joined") > factor * F.col("lines")).select(*REGION)


def _runs(elements: DataFrame) -> DataFrame:
    """Runs of equal elements on a diagonal, as long as they get: ``pair_id, region, i, j, n``."""
    old = elements.where("side = 'old'").select(*REGION, "key", F.col("start").alias("si"), F.col("size").alias("a"))
    new = elements.where("side = 'new'").select(*REGION, "key", F.col("start").alias("sj"), F.col("size").alias("b"))
    pieces = (
        old.join(new, [*REGION, "key"])
        .select(*REGION, "si", "a", "sj", "b", F.explode(F.expr("sequence(1 - a, b - 1)")).alias("o"))
        .selectExpr(
            *REGION,
            "si + greatest(0, -o) as i",
            "sj + greatest(0, o) as j",
            "least(a - greatest(0, -o), b - greatest(0, o)) as n",
        )
        .withColumn("diagonal", F.col("j") - F.col("i"))
    )
    along = Window.partitionBy(*REGION, "diagonal").orderBy("i")
    touches = F.lag(F.col("i") + F.col("n")).over(along) == F.col("i")
    return (
        pieces.withColumn("new", F.when(F.coalesce(touches, F.lit(False)), 0).otherwise(1))
        .withColumn("run", F.sum("new").over(along))
        .groupBy(*REGION, "diagonal", "run")
        .agg(F.min("i").alias("i"), F.min("j").alias("j"), F.sum("n").cast("int").alias("n"))
        .drop("diagonal", "run")
    )


def _windows(positions: DataFrame, keys: list[str], levels: int, forward: bool = True) -> DataFrame:
    """Add ``h``: hashes of the 1, 2, 4, ... lines from here on, or up to here; null beyond the end."""
    order, step = Window.partitionBy(*keys, "side").orderBy("pos"), F.lead if forward else F.lag
    out, names = positions.withColumn("h0", F.col("key")), ["h0"]
    for k in range(1, levels + 1):
        half, width = names[-1], 1 << (k - 1)
        other = step(half, width).over(order)
        reach = step("pos", width).over(order)
        there = other.isNotNull() & F.col(half).isNotNull() & (F.abs(reach - F.col("pos")) == width)
        names.append(f"h{k}")
        out = out.withColumn(names[-1], F.when(there, F.xxhash64(half, other)))
    return out.withColumn("h", F.array(*names)).drop(*names)


def _reached(points: DataFrame, near: DataFrame, levels: int, forward: bool) -> DataFrame:
    """``pair_id, d, at, end`` of points ``pair_id, d, at``: how far the lines on diagonal ``d`` are equal from there.

    The longest equal windows from a point are skipped, until none is left. Forward, ``at`` is the
    first line to look at and ``end`` is behind the last equal one; backward, ``at`` is behind the first
    line to look at and ``end`` is the last equal one.
    """
    table = checkpointed(_windows(near, ["pair_id"], levels, forward).select("pair_id", "side", "pos", "h"))
    shift, sign = (0, 1) if forward else (1, -1)
    old = table.where("side = 'old'").select("pair_id", (F.col("pos") + shift).alias("end"), F.col("h").alias("x"))
    new = table.where("side = 'new'").select("pair_id", (F.col("pos") + shift).alias("across"), F.col("h").alias("y"))
    going = points.select("pair_id", "d", "at", F.col("at").alias("end"))
    done = []
    while True:
        looked = going.withColumn("across", F.col("end") + F.col("d"))
        looked = looked.join(old, ["pair_id", "end"], "left").join(new, ["pair_id", "across"], "left")
        equal = F.expr("array_max(filter(sequence(0, size(x) - 1), k -> get(x, k) = get(y, k)))")
        level = F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), equal)
        step = F.coalesce(F.expr(f"{sign} * shiftleft(1, level)"), F.lit(0))
        moved = looked.withColumn("level", level).select("pair_id", "d", "at", (F.col("end") + step).cast("int").alias("end"), "level")
        moved = checkpointed(moved)
        done.append(moved.where("level is null").drop("level"))
        going = moved.where("level is not null").drop("level")
        if going.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _extents(runs: DataFrame, keys: DataFrame, popular: DataFrame, levels: int) -> DataFrame:
    """Add ``fi, fe``: how far the lines around a run are equal on its diagonal, popular ones included."""
    near = keys.join(popular, "pair_id", "left_semi")
    out = runs.withColumn("d", F.expr("j - i")).withColumn("e", F.expr("i + n"))
    ends = checkpointed(out.join(popular, "pair_id", "left_semi").select("pair_id", "d", "i", "e"))
    for name, forward in (("e", True), ("i", False)):
        points = ends.select("pair_id", "d", F.col(name).alias("at")).distinct()
        reached = _reached(points, near, levels, forward).withColumnRenamed("at", name).withColumnRenamed("end", f"f{name}")
        out = out.join(reached, ["pair_id", "d", name], "left").withColumn(f"f{name}", F.coalesce(f"f{name}", name))
    return out.drop("d", "e")


def _corners(blocks: DataFrame, keys: DataFrame, sizes: DataFrame, popular: DataFrame, levels: int) -> DataFrame:
    """Blocks of popular lines at the start of regions where no block begins otherwise."""
    gaps = checkpointed(_gaps(sizes.join(popular, "pair_id", "left_semi"), blocks.join(popular, "pair_id", "left_semi")))
    points = gaps.select("pair_id", F.expr("blo - alo").alias("d"), F.col("alo").alias("at"))
    reached = _reached(points, keys.join(popular, "pair_id", "left_semi"), levels, True)
    found = gaps.join(reached.select("pair_id", F.col("at").alias("alo"), "end"), ["pair_id", "alo"])
    size = F.expr("least(end, ahi, bhi - blo + alo) - alo")
    return found.select("pair_id", F.col("alo").alias("i"), F.col("blo").alias("j"), size.alias("n")).where("n > 0")


_GAPS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("i", "j", "n", "next_i", "next_j")]))


@F.arrow_udf(_GAPS)
def _chain(runs: pa.Array, alo: pa.Array, ahi: pa.Array, blo: pa.Array, bhi: pa.Array) -> pa.Array:
    """Of runs in order the first, the first after it, and so on, each with what follows it.

    A block takes in what is equal around it, up to the block before and the end of the
    region. The first entry is the start of the region.
    """
    names = ("i", "j", "n", "next_i", "next_j")
    out = []
    for listed, *bounds in zip(runs, alo, ahi, blo, bhi):
        low_i, high_i, low_j, high_j = (b.as_py() for b in bounds)
        blocks = [(low_i, low_j, 0)]
        end_i, end_j = low_i, low_j
        for run in listed.as_py():
            i, j, n = run["i"], run["j"], run["n"]
            if i >= end_i and j >= end_j:
                back = min(i - run["fi"], i - end_i, j - end_j)
                size = n + back + min(run["fe"] - i - n, high_i - i - n, high_j - j - n)
                blocks.append((i - back, j - back, size))
                end_i, end_j = i - back + size, j - back + size
        nexts = [*[b[:2] for b in blocks[1:]], (high_i, high_j)]
        out.append([dict(zip(names, (*block, *after))) for block, after in zip(blocks, nexts)])
    fields = pa.list_(pa.struct([(name, pa.int32()) for name in names]))
    return pa.array(out, fields)


def _cut(runs: DataFrame) -> list[DataFrame]:
    """Tables of blocks ``pair_id, i, j, n``, one a round.

    ``runs`` has ``pair_id, region, i, j, n``, the extents ``fi, fe``, the bounds of the region and
    ``least``: shorter parts of runs are left to a later look at the region.
    """
    blocks = []
    bounds = ["alo", "ahi", "blo", "bhi"]
    inside = Window.partitionBy(*REGION)
    order = inside.orderBy("i", "kind").rowsBetween(Window.unboundedPreceding, 0)
    runs = checkpointed(runs)
    while not runs.isEmpty():
        best = runs.withColumn("most", F.max("n").over(inside)).where("n = most")
        folded = best.groupBy(*REGION).agg(
            F.sort_array(F.collect_list(F.struct("i", "j", "n", "fi", "fe"))).alias("runs"), *[F.first(b).alias(b) for b in bounds]
        )
        gaps = checkpointed(folded.select(*REGION, F.explode(_chain("runs", *bounds)).alias("g")).select(*REGION, "g.*"))
        blocks.append(gaps.where("n > 0").select("pair_id", "i", "j", "n"))
        gap = F.struct(
            F.expr("i + n").alias("alo"), F.col("next_i").alias("ahi"), F.expr("j + n").alias("blo"), F.col("next_j").alias("bhi")
        )
        events = gaps.select(*REGION, "i", F.lit(0).alias("kind"), gap.alias("gap")).unionByName(
            runs.drop(*bounds).withColumn("kind", F.lit(1)), allowMissingColumns=True
        )
        placed = events.withColumn("gap", F.last("gap", ignorenulls=True).over(order)).where("kind = 1")
        start = F.greatest(F.col("i"), F.col("gap.alo"), F.col("gap.blo") - F.col("j") + F.col("i"))
        stop = F.least(F.col("i") + F.col("n"), F.col("gap.ahi"), F.col("gap.bhi") - F.col("j") + F.col("i"))
        clipped = placed.withColumn("start", start).withColumn("left", stop - start).where(F.col("left") >= F.col("least"))
        runs = checkpointed(
            clipped.select(
                "pair_id", F.col("gap.alo").alias("region"), F.col("start").alias("i"),
                (F.col("j") + F.col("start") - F.col("i")).alias("j"), F.col("left").cast("int").alias("n"), "fi", "fe", "least", "gap.*",
            )
        )
    return blocks


_BLOCKS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("i", "j", "n")]))


@F.arrow_udf(_BLOCKS)
def _fold_runs(runs: pa.Array, old_keys: pa.Array, new_keys: pa.Array) -> pa.Array:
    """The blocks of pairs, each from all its runs; the keys of both versions where lines are popular.

    A region's longest runs are taken as in ``_chain``, what they leave of the others falls to the gaps between them.
    A region without a run of its own can begin with popular lines.
    """

    def grown(i, j, n, low, high, a, b):
        while i > low[0] and j > low[1] and a[i - 1] == b[j - 1]:
            i, j, n = i - 1, j - 1, n + 1
        while i + n < high[0] and j + n < high[1] and a[i + n] == b[j + n]:
            n += 1
        return i, j, n

    def cut(i, j, n, a, b):
        top = int(max((i + n).max(), (j + n).max())) if len(n) else 0
        regions = [((0, 0), (top, top) if a is None else (len(a), len(b)), i, j, n)]
        blocks = []
        while regions:
            low, high, i, j, n = regions.pop()
            if not len(n):
                block = grown(*low, 0, low, high, a, b)
                if block[2]:
                    blocks.append(block)
                continue
            most = int(n.max())
            best = np.flatnonzero(n == most)
            best = best[np.lexsort((j[best], i[best]))]
            chain, end = [], low
            for x, y in zip(i[best].tolist(), j[best].tolist()):
                if x >= end[0] and y >= end[1]:
                    block = (x, y, most) if a is None else grown(x, y, most, end, high, a, b)
                    chain.append(block)
                    end = block[0] + block[2], block[1] + block[2]
            blocks.extend(chain)
            lows = [low, *[(x + m, y + m) for x, y, m in chain]]
            highs = [*[(x, y) for x, y, _ in chain], high]
            low_i, low_j = np.array(lows).T
            high_i, high_j = np.array(highs).T
            # A run begins behind the start of one block and ends before the next one's end.
            gap = np.searchsorted(high_i[:-1], i, side="right")
            start = np.maximum(i, np.maximum(low_i[gap], low_j[gap] - j + i))
            stop = np.minimum(i + n, np.minimum(high_i[gap], high_j[gap] - j + i))
            left = np.flatnonzero(stop > start)
            left = left[np.argsort(gap[left], kind="stable")]
            parts = start[left], (j + start - i)[left], (stop - start)[left]
            places = np.searchsorted(gap[left], np.arange(len(lows) + 1)).tolist()
            for k, (first, last) in enumerate(zip(places, places[1:])):
                if last > first or a is not None:
                    regions.append((lows[k], highs[k], *[part[first:last] for part in parts]))
        return blocks

    flat = runs.flatten()
    i, j, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
    out, offsets, at = [], [0], 0
    for size, a, b in zip(runs.value_lengths().to_pylist(), old_keys, new_keys):
        here = slice(at, at + size)
        out.extend(cut(i[here], j[here], n[here], a.as_py(), b.as_py()))
        offsets.append(len(out))
        at += size
    fields = [pa.array(column, pa.int32()) for column in (zip(*out) if out else ((), (), ()))]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["i", "j", "n"]))


def _folded(marked: DataFrame, popular: DataFrame | None) -> DataFrame:
    """``pair_id, i, j, n`` of all blocks, a row a pair; ``marked`` is dealt out by pair once."""
    held = spread(marked, "pair_id")

    def listed(side: str, value: Column) -> Column:
        return F.collect_list(F.when(F.col("side") == side, value)).alias(side)

    lines = held.where("not popular").groupBy("pair_id", "key").agg(*[listed(side, F.col("pos")) for side in ("old", "new")])
    pieces = lines.select("pair_id", F.explode("old").alias("i"), "new").select("pair_id", "i", F.explode("new").alias("j"))
    along = Window.partitionBy("pair_id", "diagonal").orderBy("i")
    runs = (
        pieces.withColumn("diagonal", F.col("j") - F.col("i"))
        .withColumn("run", F.col("i") - F.row_number().over(along))
        .groupBy("pair_id", "diagonal", "run")
        .agg(F.min("i").alias("i"), F.min("j").alias("j"), F.count(F.lit(1)).cast("int").alias("n"))
        .groupBy("pair_id")
        .agg(F.collect_list(F.struct("i", "j", "n")).alias("runs"))
    )
    nothing = F.lit(None).cast("array<bigint>")
    if popular is None:
        runs = runs.withColumn("old", nothing).withColumn("new", nothing)
    else:
        own = held.join(popular, "pair_id", "left_semi").groupBy("pair_id")
        own = own.agg(*[F.sort_array(listed(side, F.struct("pos", "key")))["key"].alias(side) for side in ("old", "new")])
        runs = runs.join(own, "pair_id", "full")
        runs = runs.withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<i:int,j:int,n:int>>")))
    return runs.select("pair_id", F.explode(_fold_runs("runs", "old", "new")).alias("b")).select("pair_id", "b.*")


def _gaps(sizes: DataFrame, blocks: DataFrame) -> DataFrame:
    """``pair_id, alo, ahi, blo, bhi``: regions between the blocks that have lines on both sides."""
    ends = sizes.select("pair_id", F.col("n_old").alias("i"), F.col("n_new").alias("j"), F.lit(0).alias("n"))
    starts = sizes.select("pair_id", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("n"))
    order = Window.partitionBy("pair_id").orderBy("i", "j", "n")
    listed = starts.unionByName(blocks).unionByName(ends)
    return listed.select(
        "pair_id", F.expr("i + n").alias("alo"), F.lead("i").over(order).alias("ahi"),
        F.expr("j + n").alias("blo"), F.lead("j").over(order).alias("bhi"),
    ).where("ahi > alo and bhi > blo")


def _bounds(positions: DataFrame, sizes: DataFrame, blocks: DataFrame | None) -> DataFrame:
    """Lines outside the blocks, with ``region`` (its old start) and the region's bounds."""
    if blocks is None:
        whole = sizes.select("pair_id", F.lit(0).alias("alo"), F.col("n_old").alias("ahi"), F.lit(0).alias("blo"), F.col("n_new").alias("bhi"))
        return positions.join(whole, "pair_id").withColumn("region", F.col("alo"))
    gaps = _gaps(sizes, blocks)
    gap = F.struct("alo", "ahi", "blo", "bhi")
    sided = gaps.select("pair_id", F.expr("stack(2, 'old', alo, 'new', blo) as (side, pos)"), gap.alias("gap"))
    events = sided.withColumn("kind", F.lit(0)).unionByName(positions.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    before = Window.partitionBy("pair_id", "side").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = events.withColumn("gap", F.last("gap", ignorenulls=True).over(before)).where("kind = 1")
    end = F.when(F.col("side") == "old", F.col("gap.ahi")).otherwise(F.col("gap.bhi"))
    return placed.where(F.col("pos") < end).select("pair_id", F.col("gap.alo").alias("region"), "side", "pos", "key", "gap.*")


def _foldable(marked: DataFrame, fold: int) -> DataFrame:
    """``pair_id, fold, popular``: whether the pair is small enough, and whether it has popular lines."""
    seed = lambda side: F.count_if((F.col("side") == side) & ~F.col("popular"))
    per_key = marked.groupBy("pair_id", "key").agg(
        (seed("old") * seed("new")).alias("joined"), F.count(F.lit(1)).alias("lines"), F.bool_or("popular").alias("popular")
    )
    sums = per_key.groupBy("pair_id").agg(F.sum("joined").alias("joined"), F.sum("lines").alias("lines"), F.bool_or("popular").alias("popular"))
    return sums.select("pair_id", (F.greatest("joined", "lines") <= fold).alias("fold"), "popular")


def matching_blocks(
    keys: DataFrame, autojunk: bool, factor: int = REPEAT_FACTOR, levels: int = LEVELS, fold: int = FOLD
) -> DataFrame:
    """``pair_id, i, j, n`` of all blocks, from ``pair_id, side, pos, key``."""
    sizes = checkpointed(pair_sizes(keys))
    marked = _with_popular(keys, sizes, autojunk)
    pairs = checkpointed(_foldable(marked, fold))
    kinds = {(row.fold, row.popular) for row in pairs.select("fold", "popular").distinct().collect()}
    blocks = None
    if (True, False) in kinds or (True, True) in kinds:
        small, popular = pairs.where("fold"), pairs.where("fold and popular").select("pair_id")
        blocks = checkpointed(_folded(marked.join(small.select("pair_id"), "pair_id", "left_semi"), popular if (True, True) in kinds else None))
    if blocks is not None and not {(False, False), (False, True)} & kinds:
        return blocks
    if blocks is not None:
        large = pairs.where("not fold").select("pair_id")
        keys, sizes = (checkpointed(df.join(large, "pair_id", "left_semi")) for df in (keys, sizes))
    cut = _blocks_in_rounds(keys, sizes, autojunk, factor, levels)
    return cut if blocks is None else blocks.unionByName(cut)


def _blocks_in_rounds(keys: DataFrame, sizes: DataFrame, autojunk: bool, factor: int, levels: int) -> DataFrame:
    """``pair_id, i, j, n`` of all blocks of pairs of any size."""
    marked = _with_popular(keys, sizes, autojunk)
    popular = checkpointed(marked.where("popular").select("pair_id").distinct()) if autojunk else None
    popular = None if popular is None or popular.isEmpty() else popular
    seeds = marked.where("not popular").drop("popular")
    lengths = sizes.agg(F.max(F.least("n_old", "n_new"))).first()[0] or 0
    levels = min(levels, max(lengths.bit_length() - 1, 0))
    bounds = ["region", "alo", "ahi", "blo", "bhi"]
    found: list[DataFrame] = []

    def cut(runs: DataFrame, regions: DataFrame, least: Column) -> None:
        runs = runs.withColumn("least", least)
        if popular is not None:
            runs = _extents(checkpointed(runs), keys, popular, levels)
        else:
            runs = runs.withColumn("fi", F.col("i")).withColumn("fe", F.expr("i + n"))
        found.extend(_cut(runs.join(regions, REGION)))

    def together() -> DataFrame:
        blocks = sizes.select("pair_id", *[F.lit(0).alias(c) for c in "ijn"]).where(F.lit(False))
        for more in found:
            blocks = blocks.unionByName(more)
        return blocks

    open_ = _bounds(seeds, sizes, None)
    while True:
        open_ = checkpointed(open_)
        regions = open_.select("pair_id", *bounds).distinct()
        elements = checkpointed(_elements(open_.select(*REGION, "side", "pos", "key")))
        often = checkpointed(_often_repeated(elements, factor)) if levels else None
        if often is None or often.isEmpty():
            cut(_runs(elements), regions, F.lit(1))
            break
        cut(_runs(elements.join(often, REGION, "left_anti")), regions, F.lit(1))
        # The longest windows that both versions of a region hold.
        hashed = _windows(open_.join(often, REGION, "left_semi").select(*REGION, "side", "pos", "key"), REGION, levels)
        listed = hashed.select(*REGION, "side", "pos", F.posexplode("h").alias("level", "key")).where("key is not null")
        listed = checkpointed(listed)
        common = listed.groupBy(*REGION, "level", "key").agg(F.count_if(F.col("side") == "old").alias("a"), F.count_if(F.col("side") == "new").alias("b"))
        longest = checkpointed(common.where("a > 0 and b > 0").groupBy(*REGION).agg(F.max("level").alias("level")))
        windows = _elements(listed.join(longest, [*REGION, "level"]).select(*REGION, "side", "pos", "key"))
        width = F.expr("shiftleft(1, level)")
        runs = _runs(windows).join(longest, REGION).withColumn("n", (F.col("n") + width - 1).cast("int"))
        cut(runs.withColumn("width", width).drop("level"), regions, F.col("width"))
        # Regions whose longest windows are single lines are cut to the end by now.
        left = checkpointed(longest.where("level > 0"))
        again = open_.join(left, REGION, "left_semi").select("pair_id", "side", "pos", "key", "region")
        if again.isEmpty():
            break
        open_ = _bounds(again.drop("region"), sizes, checkpointed(together()))
    blocks = together()
    return blocks if popular is None else blocks.unionByName(_corners(checkpointed(blocks), keys, sizes, popular, levels))


def hunks(
    lines: DataFrame, key: Column | str = "text", autojunk: bool = True, factor: int = REPEAT_FACTOR, fold: int = FOLD
) -> DataFrame:
    """Edit steps of every pair in order: ``pair_id, hunk_no, tag, i1, i2, j1, j2``.

    ``tag`` is ``equal``, ``replace``, ``delete`` or ``insert``.
    """
    keys = checkpointed(_keys(lines, F.col(key) if isinstance(key, str) else key))
    sizes = pair_sizes(keys)
    blocks = matching_blocks(keys, autojunk, factor, fold=fold)
    ends = sizes.select(
        "pair_id", F.col("n_old").alias("i"), F.col("n_new").alias("j"), F.lit(0).alias("n")
    )
    order = Window.partitionBy("pair_id").orderBy("i", "j")
    touches = (F.lag(F.col("i") + F.col("n")).over(order) == F.col("i")) & (
        F.lag(F.col("j") + F.col("n")).over(order) == F.col("j")
    )
    runs = (
        blocks.unionByName(ends)
        .withColumn("step", F.when(touches, 0).otherwise(1))
        .withColumn("run", F.sum("step").over(order))
        .groupBy("pair_id", "run")
        .agg(F.min("i").alias("i"), F.min("j").alias("j"), F.sum("n").cast("int").alias("n"))
    )
    by_run = Window.partitionBy("pair_id").orderBy("run")
    i0 = F.coalesce(F.lag(F.col("i") + F.col("n")).over(by_run), F.lit(0))
    j0 = F.coalesce(F.lag(F.col("j") + F.col("n")).over(by_run), F.lit(0))

    def step(tag: Column, i1: Column, i2: Column, j1: Column, j2: Column) -> Column:
        return F.struct(
            tag.alias("tag"), i1.alias("i1"), i2.alias("i2"), j1.alias("j1"), j2.alias("j2")
        )

    i, j, n = F.col("i"), F.col("j"), F.col("n")
    gap = (
        F.when((F.col("i0") < i) & (F.col("j0") < j), F.lit("replace"))
        .when(F.col("i0") < i, F.lit("delete"))
        .when(F.col("j0") < j, F.lit("insert"))
    )
    steps = F.array(
        F.when(gap.isNotNull(), step(gap, F.col("i0"), i, F.col("j0"), j)),
        F.when(n > 0, step(F.lit("equal"), i, i + n, j, j + n)),
    )
    return (
        runs.select("pair_id", "i", "j", "n", "run", i0.alias("i0"), j0.alias("j0"))
        .select("pair_id", F.posexplode(steps).alias("part", "h"), "run")
        .where("h is not null")
        .select(
            "pair_id",
            F.row_number()
            .over(Window.partitionBy("pair_id").orderBy("run", "part"))
            .alias("hunk_no"),
            "h.*",
        )
    )


def exact_edges(steps: DataFrame) -> DataFrame:
    """Line pairs of the equal hunks, 1-based."""
    return (
        steps.where("tag = 'equal'")
        .select("pair_id", "i1", "j1", F.explode(F.sequence(F.lit(1), F.col("i2") - F.col("i1"))).alias("k"))
        .select(
            "pair_id",
            (F.col("i1") + F.col("k")).alias("old_line"),
            (F.col("j1") + F.col("k")).alias("new_line"),
        )
    )


def change_ranges(steps: DataFrame) -> DataFrame:
    """Deleted (old) and added (new) ranges: ``pair_id, side, range_no, start, end``.

    ``start`` and ``end`` are 0-based and half-open; ranges are numbered in order.
    """
    changed = steps.where("tag <> 'equal'")
    ranges = changed.select(
        "pair_id", F.lit("old").alias("side"), F.col("i1").alias("start"), F.col("i2").alias("end")
    ).unionByName(
        changed.select(
            "pair_id",
            F.lit("new").alias("side"),
            F.col("j1").alias("start"),
            F.col("j2").alias("end"),
        )
    )
    order = Window.partitionBy("pair_id", "side").orderBy("start")
    return ranges.where("start < end").select(
        "pair_id", "side", F.row_number().over(order).alias("range_no"), "start", "end"
    )


def unmatched(lines: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines of either side that no edge names: ``pair_id, side, line_no``."""
    used = (
        edges.select("pair_id", F.expr("stack(2, 'old', old_line, 'new', new_line) as (side, line_no)"))
        .where("line_no is not null")
        .distinct()
    )
    return lines.select("pair_id", "side", "line_no").join(
        used, ["pair_id", "side", "line_no"], "left_anti"
    )
