import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from linetrace.operators import align, merge


def random_pairs(seed, count, long):
    rng = random.Random(seed)
    pairs = {}
    for number in range(count):
        letters = rng.choice([3, 8, 60, 400])
        old = [str(rng.randrange(letters)) for _ in range(rng.choice([0, 3, 25, long]))]
        new = [x for x in old if rng.random() > 0.15]
        for _ in range(rng.randrange(1 + len(old) // 3)):
            new.insert(rng.randrange(len(new) + 1), str(rng.randrange(letters)))
        if rng.random() < 0.2:
            new = [str(rng.randrange(letters)) for _ in range(rng.choice([0, 5, long]))]
        pairs[f"p{number}"] = (old, new)
    return pairs


def by_pair(rows):
    result = {}
    for row in rows:
        result.setdefault(row.pair_id, []).append((row.tag, row.i1, row.i2, row.j1, row.j2))
    return result


@pytest.mark.parametrize("autojunk, factor, long", [(False, 8, 60), (False, 0, 90), (True, 8, 260), (True, 0, 230)])
def test_hunks_follow_the_sequence_matcher(make_lines, autojunk, factor, long):
    """With factor 0 every region goes by windows of lines."""
    pairs = random_pairs(7, 30, long)
    steps = align.hunks(make_lines(pairs), "text", autojunk, factor)
    got = by_pair(steps.orderBy("pair_id", "hunk_no").collect())
    for pair, (old, new) in pairs.items():
        assert got.get(pair, []) == SequenceMatcher(None, old, new, autojunk=autojunk).get_opcodes(), pair


def test_runs_of_one_line(make_lines):
    rng = random.Random(3)

    def version():
        return [x for _ in range(rng.randrange(1, 9)) for x in rng.choice("xxyz") * rng.randrange(1, 7)]

    pairs = {"p": (["x"] * 300 + ["a"], ["b"] + ["x"] * 290)} | {f"q{k}": (version(), version()) for k in range(40)}
    steps = align.hunks(make_lines(pairs), "text", autojunk=False)
    got = by_pair(steps.orderBy("pair_id", "hunk_no").collect())
    for pair, versions in pairs.items():
        assert got[pair] == SequenceMatcher(None, *versions, autojunk=False).get_opcodes()


def test_many_equal_lines_and_many_blocks(spark):
    """A pair with 100,000 equal lines a side, and one with 400 single blocks, by joins alone."""
    wide = spark.range(100_000).selectExpr("'w' as pair_id", "'old' as side", "int(id + 1) as line_no", "'x' as text")
    wide = wide.unionByName(wide.where("line_no < 99000").withColumn("side", F.lit("new")))
    many = spark.range(800).selectExpr("'m' as pair_id", "'old' as side", "int(id + 1) as line_no", "if(id % 2 = 0, 'k' || id, 'o' || id) as text")
    many = many.unionByName(many.selectExpr("pair_id", "'new' as side", "line_no", "replace(text, 'o', 'n') as text"))
    steps = align.hunks(wide.unionByName(many), "text", autojunk=False)
    got = by_pair(steps.orderBy("pair_id", "hunk_no").collect())
    assert got["w"] == [("equal", 0, 98999, 0, 98999), ("delete", 98999, 100000, 98999, 98999)]
    assert len(got["m"]) == 800 and all(tag == ("equal", "replace")[k % 2] for k, (tag, *_) in enumerate(got["m"]))


def test_edges_ranges_and_unmatched(make_lines):
    pairs = {"p": (["a", "b", "c", "d"], ["a", "x", "y", "c", "d", "e"]), "same": (["q"], ["q"])}
    lines = make_lines(pairs)
    steps = align.hunks(lines)
    edges = align.exact_edges(steps)
    assert {tuple(r) for r in edges.collect()} == {("p", 1, 1), ("p", 3, 4), ("p", 4, 5), ("same", 1, 1)}
    assert {tuple(r) for r in align.change_ranges(steps).collect()} == {
        ("p", "old", 1, 1, 2), ("p", "new", 1, 1, 3), ("p", "new", 2, 5, 6),
    }
    assert {tuple(r) for r in align.unmatched(lines, edges).collect()} == {
        ("p", "old", 2), ("p", "new", 2), ("p", "new", 3), ("p", "new", 6),
    }
    assert {tuple(r) for r in merge.pair_status(steps, lines).collect()} == {("p", 1), ("same", 0)}


@pytest.mark.parametrize("autojunk, factor, fold", [(False, 8, align.FOLD), (True, 8, align.FOLD), (True, 8, 400), (False, 0, 0)])
def test_small_pairs_take_no_rounds(make_lines, monkeypatch, autojunk, factor, fold):
    """Pairs of up to ``fold`` lines and joined lines are cut in one row each, larger ones by rounds, with the same steps."""
    rounds, in_rounds = [], align._blocks_in_rounds
    monkeypatch.setattr(align, "_blocks_in_rounds", lambda *given: rounds.append(given[1].count()) or in_rounds(*given))
    blank = [x for k in range(150) for x in (f"s{k}", "")]
    pairs = random_pairs(11, 12, 230) | {"popular": (blank, blank[:80] + ["x"] + blank[40:]), "all": ([""] * 300, [""] * 250 + ["y"])}
    steps = align.hunks(make_lines(pairs), "text", autojunk, factor, fold)
    got = by_pair(steps.orderBy("pair_id", "hunk_no").collect())
    filled = sum(1 for old, new in pairs.values() if old or new)
    assert rounds == [] if fold == align.FOLD else rounds == [filled] if fold == 0 else 0 < rounds[0] < filled
    for pair, (old, new) in pairs.items():
        assert got.get(pair, []) == SequenceMatcher(None, old, new, autojunk=autojunk).get_opcodes(), pair
