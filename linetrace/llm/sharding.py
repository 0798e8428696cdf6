"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import random
from math import exp, lgamma

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linetrace.llm.common import packed
from linetrace.session import checkpointed

SHARDS = 40
SEED = 2024
#: Rows of a source partition, and of a range of slots, on average: the unit of sorting.
PART_ROWS = 1 << 18
LEAST_PARTS = 64


def hypergeometric(draw: random.Random, good: int, bad: int, drawn: int) -> int:
    """Number of good ones among ``drawn`` without replacement, by inversion.

    Probabilities are summed from the mode outwards, so about as many steps are
    taken as the standard deviation has units.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad

    def log_choose(n: int, k: int) -> float:
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)

    mode = min(high, max(low, (good + 1) * (drawn + 1) // (total + 2)))
    peak = exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(total, drawn))
    u = draw.random() - peak
    up = down = mode
    p_up = p_down = peak
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def communication_matrix(part_rows: list[int], shard_rows: list[int], seed: int = SEED) -> list[list[int]]:
    """How many rows each part sends to each shard, as a uniform shuffle would.

    Row sums are ``part_rows`` and column sums ``shard_rows``. Parts draw one after the
    other from what the shards have left, a shard at a time. Size: parts times shards.
    """
    draw = random.Random(seed)
    left, matrix = list(shard_rows), []
    for rows in part_rows:
        room, line = sum(left), []
        for shard, capacity in enumerate(left):
            room -= capacity
            count = hypergeometric(draw, capacity, room, rows - sum(line)) if rows > 0 else 0
            line.append(count)
        left = [a - b for a, b in zip(left, line)]
        matrix.append(line)
    return matrix


def shuffled_shards(
    documents: DataFrame,
    by: tuple[str, ...] = ("doc_id", "text"),
    shards: int = SHARDS,
    seed: int = SEED,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Each row as struct ``row`` with its ``shard`` and ``slot``.

    Shard sizes are at most one apart, slots run from 0 without gaps in each shard.
    Rows are put into parts by a hash of the columns ``by``. The driver sees the number of
    rows of each part and draws the matrix of part-to-shard counts. Every part then
    shuffles its rows by a second hash and deals them out by its line of the matrix;
    every shard shuffles again by a third one. Shards are numbered in ranges of
    that hash with prefix sums, so no task sorts a whole shard. All orders come from
    hashes of the content, so a recomputed task gives the same rows.

    Nulls in ``by`` are hashed like values. Rows that repeat in all of ``by`` are
    interchangeable and start in one part. No rows give no rows.
    """
    columns = [F.col(f"`{c}`") for c in by]
    keyed = packed(documents, **{f"k{n}": F.xxhash64(F.lit(seed + n), *columns) for n in range(3)})
    n_rows = documents.count()
    parts = max(LEAST_PARTS, -(-n_rows // part_rows))
    keyed = keyed.withColumn("part", F.expr(f"pmod(k0, {parts}L)").cast("int"))
    counts = dict(keyed.groupBy("part").count().collect())
    shard_rows = [n_rows // shards + (s < n_rows % shards) for s in range(shards)]
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], shard_rows, seed)
    ends = []
    for part, line in enumerate(matrix):
        total, cuts = 0, []
        for count in line:
            total += count
            cuts.append(total)
        ends.append((part, cuts))
    spark = documents.sparkSession
    ends = spark.createDataFrame(ends, "part int, ends array<bigint>")
    order = Window.partitionBy("part").orderBy("k1", "k2", "k0")
    ranges = max(1, -(-n_rows // shards // part_rows))
    dealt = checkpointed(
        keyed.withColumn("rank", F.row_number().over(order) - 1)
        .join(ends, "part")
        .select("row", "k2", "k1", F.expr("size(filter(ends, e -> e <= rank))").alias("shard"))
        .withColumn("range", F.expr(f"cast(floor((k2 / 18446744073709551616.0D + 0.5D) * {ranges}) as int)"))
    )
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "range").count().select(
        "shard", "range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset")
    )
    again = Window.partitionBy("shard", "range").orderBy("k2", "k1")
    return (
        dealt.withColumn("place", F.row_number().over(again) - 1)
        .join(offsets, ["shard", "range"])
        .select("row", "shard", (F.col("offset") + F.col("place")).cast("bigint").alias("slot"))
    )
