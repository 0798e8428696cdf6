"""The three mappings against plain loops written from their definitions."""

import hashlib
import math
import random
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest
from conftest import edited_pairs
from pyspark.sql import functions as F

from linetrace.functions import gestalt
from linetrace.functions.text import KEYWORDS, PUNCTUATION
from linetrace.operators import assign, context, thin
from linetrace.plans.best import map_best
from linetrace.plans.hybrid import map_hybrid
from linetrace.plans.ranges import map_ranges


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def alike(a, b):
    if not a or not b:
        return float(a == b)
    return 1.0 - edits(a, b) / max(len(a), len(b))


def bags_cosine(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    if not x or not y:
        return float(not x and not y)
    size = lambda c: math.sqrt(sum(v * v for v in c.values()))
    return sum(v * y[k] for k, v in x.items()) / (size(x) * size(y))


class Version:
    def __init__(self, lines):
        gone = str.maketrans("", "", PUNCTUATION)
        self.pre = [" ".join(re.sub(r"\s+", " ", t.lower().translate(gone)).split()) for t in lines]
        filled = [k for k, p in enumerate(self.pre) if p]
        self.filled = set(filled)
        self.kinds, self.context, self.print = {}, {}, {}
        for at, k in enumerate(filled):
            tokens = [t for t in re.split("[^a-z0-9_]+", self.pre[k]) if t]
            kinds = [t if t in KEYWORDS else "NUM" if t.isdigit() else "ID" for t in tokens]
            self.kinds[k] = " ".join(kinds)
            near = filled[max(0, at - 4) : at][::-1] + filled[at + 1 : at + 5]
            self.context[k] = " ".join(self.pre[n] for n in near)
            hashes = [int(hashlib.md5(t.encode()).hexdigest()[:16], 16) for t in kinds]
            self.print[k] = sum(
                1 << b for b in range(64) if sum(1 if h >> b & 1 else -1 for h in hashes) > 0
            )


def hybrid(old_lines, new_lines):
    old, new = Version(old_lines), Version(new_lines)

    def score(i, j):
        return (
            0.5 * alike(old.pre[i], new.pre[j])
            + 0.3 * alike(old.kinds[i], new.kinds[j])
            + 0.2 * bags_cosine(old.context[i], new.context[j])
        )

    targets = {}
    for i, j, n in SequenceMatcher(None, old.pre, new.pre, autojunk=False).get_matching_blocks():
        for k in range(n):
            if i + k in old.filled:
                targets[i + k] = {j + k}
    taken = {j for t in targets.values() for j in t}
    offers = []
    for i in old.filled - set(targets):
        free = [j for j in new.filled if j not in taken]
        free.sort(key=lambda j: ((old.print[i] ^ new.print[j]).bit_count(), -j))
        offers += [(score(i, j), i, j) for j in free[:15]]
    for s, i, j in sorted(offers, reverse=True):
        if s >= 0.35 and i not in targets and j not in taken:
            targets[i] = {j}
            taken.add(j)
    for i in sorted(targets):
        (j,) = targets[i]
        for k in (j - 1, j + 1):
            if k in new.filled and score(i, k) >= 0.65:
                targets[i].add(k)
    for i in range(len(old.pre)):
        for n in (i - 1, i + 1):
            if i in targets and n in old.filled and n not in targets and score(n, min(targets[i])) >= 0.65:
                targets[n] = {min(targets[i])}
    return {(i + 1, j + 1) for i, t in targets.items() for j in t}


def ranges(old, new):
    steps = SequenceMatcher(None, old, new).get_opcodes()
    result = {i1 + k: j1 + k for tag, i1, i2, j1, _ in steps if tag == "equal" for k in range(i2 - i1)}
    gone = [(a, b) for tag, a, b, _, _ in steps if tag != "equal" and a < b]
    come = [(a, b) for tag, _, _, a, b in steps if tag != "equal" and a < b]

    def weights(spans, lines):
        counts = [Counter(t for x in lines[a:b] for t in re.findall(r"\w+", x)) for a, b in spans]
        seen = Counter(t for c in counts for t in c)
        return [
            {t: f * (math.log((len(spans) + 1) / (seen[t] + 1)) + 1) for t, f in c.items()} for c in counts
        ]

    for (a, b), x in zip(gone, weights(gone, old)):
        for (c, d), y in zip(come, weights(come, new)):
            if not set(x) & set(y):
                continue
            edges = sorted(
                (0.0 if old[i] == new[j] else 1 - alike(old[i], new[j]), i + j, i, j)
                for i in range(a, b)
                for j in range(c, d)
            )
            low = (a, c)
            for distance, _, i, j in edges:
                if distance < 0.4 - 1e-12 and i >= low[0] and j >= low[1]:
                    result[i] = j
                    low = (i + 1, j + 1)
    return {(i + 1, j + 1) for i, j in result.items()}


def best(old, new, monotone):
    fold = lambda t: re.sub(r"\s+", " ", t.strip().lower())
    used, bound, result = set(), 0, set()
    for i, text in enumerate(old):
        free = [j for j in range(bound if monotone else 0, len(new)) if j not in used]
        rated = [(-SequenceMatcher(None, fold(text), fold(new[j])).ratio(), j) for j in free]
        if rated and -min(rated)[0] >= 0.75:
            j = min(rated)[1]
            used.add(j)
            bound = j + 1
            result.add((i + 1, j + 1))
    return result


def edges_of(mapping):
    result = {}
    for row in mapping.collect():
        result.setdefault(row.pair_id, set()).add((row.old_line, row.new_line))
    return result


@pytest.fixture(scope="module")
def pairs():
    made = edited_pairs(3, 40)
    made["split"] = (["total value alpha beta gamma delta"], ["total value alpha", "beta gamma delta"])
    made["copies"] = (["alpha beta gamma"] * 6, ["alpha beta gammas"] * 5)
    made["moved"] = (["a b c", "d e f", "g h i j"], ["g h i k", "a b c", "d e f"])
    return made


def check(mapping, pairs, model):
    got = edges_of(mapping)
    for pair, (old, new) in pairs.items():
        assert got.get(pair, set()) == model(old, new), (pair, old, new)


def test_hybrid(make_lines, pairs):
    mapping = map_hybrid(make_lines(pairs))
    check(mapping, pairs, hybrid)
    kinds = {r.kind for r in mapping.select("kind").distinct().collect()}
    assert kinds == {"exact", "greedy", "split", "merge"}


def test_ranges(make_lines, pairs):
    check(map_ranges(make_lines(pairs)), pairs, ranges)


@pytest.mark.parametrize("monotone", [True, False])
def test_best(make_lines, pairs, monotone):
    long = {"long": (["q" * 150 + "abc" * 40, "zz"], ["q" * 150 + "abd" * 40, "zz"])}
    both = {**pairs, **long}
    check(map_best(make_lines(both), monotone=monotone), both, lambda o, n: best(o, n, monotone))


def test_best_keeps_misses(make_lines):
    lines = make_lines({"p": (["alpha beta", "other"], ["alpha beta"])})
    rows = {(r.old_line, r.new_line) for r in map_best(lines, keep_misses=True).collect()}
    assert rows == {(1, 1), (2, None)}


@pytest.mark.parametrize("fold_edges", [0, 10_000])
def test_greedy_assignment(spark, fold_edges):
    rng = random.Random(11)
    edges = [
        (f"p{p}", i, j, rng.choice([0.2, 0.4, 0.5, 0.8]))
        for p in range(8)
        for i in range(7)
        for j in range(7)
        if rng.random() < 0.6
    ]
    frame = spark.createDataFrame(edges, "pair_id string, old_line int, new_line int, score double")
    got = {(r.pair_id, r.old_line, r.new_line) for r in assign.assign_greedy(frame, 0.35, fold_edges).collect()}
    expected, used = set(), set()
    for s, i, j, p in sorted(((s, i, j, p) for p, i, j, s in edges), reverse=True):
        if s >= 0.35 and (p, "o", i) not in used and (p, "n", j) not in used:
            used |= {(p, "o", i), (p, "n", j)}
            expected.add((p, i, j))
    assert got == expected


def test_greedy_staircase(spark, monkeypatch):
    """Every edge waits for the one before: rounds of mutual best edges alone would be 5,000."""
    n, rounds = 5000, []
    mutual = assign._mutual_best
    monkeypatch.setattr(assign, "_mutual_best", lambda edges: rounds.append(1) or mutual(edges))
    number = F.col("id").cast("int")
    frame = spark.range(2 * n).select(
        F.lit("p").alias("pair_id"),
        ((number + 1) / 2).cast("int").alias("old_line"),
        (number / 2).cast("int").alias("new_line"),
        (1 - number / (4.0 * n)).alias("score"),
    )
    got = {(r.old_line, r.new_line) for r in assign.assign_greedy(frame, 0.0, 2000).collect()}
    assert got == {(k, k) for k in range(n)}
    assert 0 < len(rounds) < 20


@pytest.mark.parametrize("fold_edges", [1, 3, 10, 10_000])
def test_thinning_in_rounds(spark, fold_edges):
    rng = random.Random(fold_edges)
    rows, expected = [], {}
    for group in range(6):
        sides = [[rng.randrange(9) for _ in range(rng.randrange(1, 25))] for _ in range(2)]
        at = [{t: [k for k, x in enumerate(side, 1) if x == t] for t in set(side)} for side in sides]
        lines = []
        for a, olds in at[0].items():
            for b, news in at[1].items():
                d = 0.0 if a == b else rng.choice([0.1, 0.2, 0.3, None])
                if d is not None:
                    rows.append(("p", group, group, 100 * group, olds, news, d))
                    lines += [(d, i + j, i, j) for i in olds for j in news]
        bound = (0, 0)
        for d, _, i, j in sorted(lines):
            if i > bound[0] and j > bound[1]:
                bound = (i, j)
                expected[100 * group + i] = (100 * group + j, 1 - d)
    frame = spark.createDataFrame(
        rows, "pair_id string, old_range int, new_range int, base int, old_at array<int>, new_at array<int>, d double"
    )
    for side in ("old_at", "new_at"):
        frame = frame.withColumn(side, F.expr(f"transform({side}, line -> line + base)"))
    got = {r.old_line: (r.new_line, r.score) for r in thin.thin(frame.drop("base"), fold_edges).collect()}
    assert got == expected


def test_normal_and_context(make_lines):
    lines = make_lines({"p": (["Foo_Bar( a.b );", ");", "}", "x", "y", "z", "w"], [])})
    pre = context.normal_lines(lines)
    assert [r.pre for r in pre.orderBy("line_no").collect()] == ["foobar ab", "", "}", "x", "y", "z", "w"]
    rows = {r.line_no: r.ctx for r in context.context_of(pre).select("line_no", "ctx").collect()}
    assert rows[6] == "y x } foobar ab w"
    assert 2 not in rows
    assert pre.where(F.col("pre") == "").count() == 1


@pytest.mark.parametrize("block_lines", [1, 2, 3, 7, 1000])
def test_context_over_blocks(spark, make_lines, block_lines):
    rng = random.Random(block_lines)
    pairs = {f"p{k}": [[rng.choice(["", "", f"w{n}"]) for n in range(rng.randrange(40))] for _ in range(2)] for k in range(6)}
    pre = context.normal_lines(make_lines(pairs))
    got = {(r.pair_id, r.side, r.line_no): r.ctx for r in context.context_of(pre, block_lines=block_lines).collect()}
    expected = {}
    for pair, versions in pairs.items():
        for side, texts in zip(("old", "new"), versions):
            kept = [(number, text) for number, text in enumerate(texts, 1) if text]
            for k, (number, _) in enumerate(kept):
                near = kept[max(k - 4, 0) : k][::-1] + kept[k + 1 : k + 5]
                expected[pair, side, number] = " ".join(text for _, text in near)
    assert got == expected


def test_common_subsequence_reaches():
    """The bound on the gestalt ratio is the longest common subsequence, also over borders of looks."""
    rng = random.Random(7)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcé\U0001f600") for _ in range(rng.randrange(1, 150))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = [0]
            for j, y in enumerate(b):
                last.append(row[j] + 1 if x == y else max(row[j + 1], last[-1]))
            row = last
        for least in (0, row[-1] - 1, row[-1], row[-1] + 1):
            assert gestalt.common_reaches(a, gestalt.places(b), len(b), least) == (row[-1] >= least)


def test_ratios_of_mixed_up_texts_are_not_computed(spark):
    """Few edits by distance, but no common subsequence that is long enough: null, and the ratio otherwise."""
    rows = [("ab" * 40, "ba" * 40), ("abcd" * 20, "dcba" * 20), ("the same line", "the same lines")]
    ratio = gestalt.gestalt_ratio_from(0.75, "old", "new").alias("ratio")
    found = [r.ratio for r in spark.createDataFrame(rows, "old string, new string").coalesce(1).select(ratio).collect()]
    exact = [SequenceMatcher(None, a, b).ratio() for a, b in rows]
    assert found[1] is None and exact[1] < 0.75
    assert [found[0], found[2]] == [exact[0], exact[2]]


def test_texts_meet_over_the_borders_of_length_classes(spark, make_lines):
    from linetrace.operators import best

    words = ["a" * n for n in range(1, 140)]
    for threshold in (0.6, 0.75, 0.95):
        edges = best.ratio_edges(make_lines({"p": (words, words)}), threshold)
        got = sorted((o, n) for r in edges.collect() for o in r.old_at for n in r.new_at)
        assert got == [(o, n) for o in range(1, 140) for n in range(1, 140) if 2.0 * min(o, n) / (o + n) >= threshold]
        # A text next to no border moves once, and no pair of texts moves.
        plan = edges._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 1 and plan.index("Join") < plan.index("RepartitionByExpression")
