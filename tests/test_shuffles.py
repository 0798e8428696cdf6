"""What moves through the shuffle: numbers and keys, and every text once."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from linetrace.functions import text as T
from linetrace.operators import ranges
from linetrace.sources.documents import pair_votes

RANGES = "pair_id string, side string, range_no int, start int, end int"


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range)partitioning.*", plan)


def versions(make_lines):
    old = ["a b a", "skip", "c d", "e e f"]
    new = ["a b x", "skip", "d d c", "g"]
    return make_lines({"p": (old, new), "q": (["a b a"], ["z"])})


def spans(spark):
    rows = [("p", s, 1, 0, 1) for s in ("old", "new")] + [("p", s, 2, 2, 4) for s in ("old", "new")] + [("q", s, 1, 0, 1) for s in ("old", "new")]
    return spark.createDataFrame(rows, RANGES)


def plain_cosine(texts):
    """``texts``: side -> range -> words of one pair."""
    weights = {}
    for side, held in texts.items():
        df = Counter(t for words in held.values() for t in set(words))
        weights[side] = {
            r: {t: n * (math.log((len(held) + 1) / (df[t] + 1)) + 1) for t, n in Counter(words).items()} for r, words in held.items()
        }
    out = {}
    for a, x in weights["old"].items():
        for b, y in weights["new"].items():
            dot = sum(w * y.get(t, 0) for t, w in x.items())
            if dot:
                out[a, b] = dot / math.sqrt(sum(w * w for w in x.values()) * sum(w * w for w in y.values()))
    return out


def test_texts_of_ranges_move_once(spark, make_lines):
    members = ranges.range_lines(versions(make_lines), spans(spark))
    weights = ranges.term_weights(members)
    found = ranges.range_cosine(weights)
    # One by pair for the texts and one for the numbers of ranges; all the rest stays.
    assert len(exchanges(found)) == 2
    rows = {(r.side, r.range_no, r.line_no, r.n_ranges) for r in members.where("pair_id = 'p'").collect()}
    assert rows == {(s, r, n, 2) for s in ("old", "new") for r, n in ((1, 1), (2, 3), (2, 4))}
    expected = plain_cosine({"old": {1: "a b a".split(), 2: "c d e e f".split()}, "new": {1: "a b x".split(), 2: "d d c g".split()}})
    got = {(r.old_range, r.new_range): r.sim for r in found.collect() if r.pair_id == "p"}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-12 for k in got)
    assert found.where("pair_id = 'q'").isEmpty()


def test_votes_move_keys_of_lines(spark):
    rows = [(1, "same line\nb"), (2, "same line\nb\nc"), (3, "same line"), (3, "same line"), (None, "same line"), (4, None)]
    votes = pair_votes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in votes.collect()} == {(2, 1, 2), (3, 2, 1)}
    # The column that lines meet by is a key of 32 bytes, not the text.
    plan = votes._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan


def test_key_is_of_the_whole_text(spark):
    texts = ["", "a", "A", "a ", "é", "é", "x" * 5000, "x" * 5001]
    keys = spark.createDataFrame([(t,) for t in texts], "t string").select(T.text_key(F.col("t")).alias("k")).collect()
    assert len({bytes(r.k) for r in keys}) == len(texts) and all(len(r.k) == 32 for r in keys)


def test_contexts_move_as_text(spark, make_lines):
    from linetrace.operators import candidates, context

    lines = make_lines({"p": (["a b", "c d", "e f"], ["a b x", "c d y", "g"])})
    features = context.structured(context.context_of(context.normal_lines(lines)))
    old, new = features.where("side = 'old'"), features.where("side = 'new'")
    met = candidates.candidate_features(old, new, ["line_no", "ctx"])
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    # No count of words lies below the last exchange of either side.
    below = plan[plan.index("RepartitionByExpression") :]
    assert "old_bag" not in below.split("Project", 1)[0]
    assert all("map_from_arrays" not in part.split("\n", 1)[1] for part in plan.split("RepartitionByExpression")[-1:])
    rows = {(r.old_line, r.new_line): (r.old_bag, r.new_bag) for r in met.collect()}
    assert len(rows) == 9
    assert rows[1, 2] == ({"c": 1, "d": 1, "e": 1, "f": 1}, {"a": 1, "b": 1, "x": 1, "g": 1})
