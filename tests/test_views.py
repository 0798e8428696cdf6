from linetrace.operators import merge
from linetrace.operators.positional import compare_positional
from linetrace.plans.quality import quality
from linetrace.sinks import reports

STEPS = "pair_id string, hunk_no int, tag string, i1 int, i2 int, j1 int, j2 int"


def texts(report):
    return [r.value for r in report.orderBy("pair_id", "section", "line").collect()]


def test_positional_report(make_lines):
    lines = make_lines({"p": (["a", "b", "c"], ["a", "x"])})
    assert texts(reports.positional_report(compare_positional(lines))) == [
        "  Line 1: same    -> a",
        "~ Line 2: changed from 'b' to 'x'",
        "- Line 3: removed -> c",
    ]
    assert texts(reports.positional_report(compare_positional(make_lines({"p": ([], ["n"])})))) == [
        "+ Line 1: added   -> n"
    ]


def test_mapping_report(spark, make_lines, tmp_path):
    lines = make_lines({"p": (["a", "b"], ["a", "b", "c", "d"]), "q": (["z"], ["z"])})
    edges = [("p", 1, 3), ("p", 1, 1), ("p", 1, 2), ("q", 1, 1)]
    mapping = spark.createDataFrame(edges, "pair_id string, old_line int, new_line int")
    p = ["1 -> 1, 2, 3", "", reports.DELETED, "OLD 2", "", reports.ADDED, "NEW 4"]
    q = ["1 -> 1"]
    assert texts(reports.mapping_report(mapping, lines)) == p + q
    none = ["", reports.DELETED, "(none)", "", reports.ADDED, "(none)"]
    assert texts(reports.mapping_report(mapping, lines, empty="none")) == p + q + none
    assert texts(reports.mapping_report(mapping, lines, style="dash", show_unmatched=False)) == ["1-1, 2, 3", "1-1"]
    report = reports.mapping_report(mapping, lines)
    reports.write_report(report, str(tmp_path / "out"), folder_per_pair=True)
    (part,) = (tmp_path / "out" / "pair_id=p").glob("*.txt")
    assert part.read_text().split("\n")[:-1] == p
    reports.write_report(report, str(tmp_path / "files"), buckets=2)
    rows = [x for f in (tmp_path / "files").glob("*.txt") for x in f.read_text().split("\n")[:-1]]
    assert [x for x in rows if x[0] == "p"] == [f"p\t{x}" for x in p] and len(rows) == len(p + q)
    reports.write_table(mapping, str(tmp_path / "table"), buckets=2)
    assert spark.read.parquet(str(tmp_path / "table")).count() == len(edges)
    numbers = [r.row_no for r in reports.ordered_report(report).where("pair_id = 'p'").orderBy("section", "line").collect()]
    assert numbers == list(range(1, len(p) + 1))


def test_pairs_without_lines(spark, make_lines):
    lines = make_lines({"ok": (["a"], ["b"]), "blank": (["", ""], [""])})
    pairs = spark.createDataFrame([("ok",), ("blank",), ("empty",)], "pair_id string")
    steps = merge.hunks_with_ends(lines)
    status = {r.pair_id: r.status for r in merge.pair_status(steps, pairs).collect()}
    assert status == {"ok": 1, "blank": 1, "empty": 0}
    choices = steps.where("tag <> 'equal'").selectExpr("pair_id", "hunk_no", "'r' choice", "cast(null as string) edited_text")
    merged = {r.pair_id: r.merged for r in merge.merge(lines, steps, choices, pairs=pairs).collect()}
    assert merged == {"ok": "b\n", "blank": "\n", "empty": ""}
    none = spark.createDataFrame([], "pair_id string, old_line int, new_line int")
    report = reports.mapping_report(none, lines.where("text <> ''"), empty="none", pairs=pairs)
    nothing = ["", reports.DELETED, "(none)", "", reports.ADDED, "(none)"]
    assert texts(report.where("pair_id = 'empty'")) == nothing == texts(report.where("pair_id = 'blank'"))


def test_side_by_side(make_lines):
    lines = make_lines({"p": (["same", "left is long", "gone"], ["same", "right", "k", "new"])})
    steps = lines.sparkSession.createDataFrame(
        [("p", 1, "equal", 0, 1, 0, 1), ("p", 2, "replace", 1, 2, 1, 3), ("p", 3, "delete", 2, 3, 3, 3), ("p", 4, "insert", 3, 3, 3, 4)],
        STEPS,
    )
    rows = merge.side_by_side(lines, steps, width=19).orderBy("hunk_no", "row_no").collect()
    assert [r.row for r in rows] == [
        "same       same", "left is  | right", "         | k", "gone     < ", "         > new",
    ]
    short = merge.side_by_side(lines, steps, width=19, suppress_common=True)
    assert short.where("hunk_no = 1").count() == 0


def test_merge_choices(spark):
    rows = [("old", 1, "a", True), ("old", 2, "b", True), ("old", 3, "c", False), ("new", 1, "x", True), ("new", 2, "c", True)]
    choices = {
        "l": "a\nb\nc", "1": "a\nb\nc", "R": "x\nc\n", "el": "a\nb\nc\n", "er": "x\nc\n", "eb": "a\nb\nc\nx\nc\n",
        "ed": "--- f lines 1-3\na\nb\nc\n+++ g lines 1-2\nx\nc\n", "e": "", "q": None, "?": None,
    }
    lines = spark.createDataFrame(
        [(c, *row) for c in [*choices, "none", "own"] for row in rows],
        "pair_id string, side string, line_no int, text string, has_eol boolean",
    )
    steps = merge.hunks_with_ends(lines)
    assert steps.where("pair_id = 'l'").count() == 1
    decisions = spark.createDataFrame(
        [(c, 1, c, None) for c in choices] + [("own", 1, "el", "mine")],
        "pair_id string, hunk_no int, choice string, edited_text string",
    )
    got = {r.pair_id: r.merged for r in merge.merge(lines, steps, decisions, "f", "g").collect()}
    assert got == {**choices, "none": None, "own": "mine"}


def test_merge_does_not_broadcast_lines(spark, make_lines):
    lines = make_lines({"p": (["a", "b", "c"], ["a", "x", "c"])})
    steps = merge.hunks_with_ends(lines)
    decisions = spark.createDataFrame([("p", 2, "r", None)], "pair_id string, hunk_no int, choice string, edited_text string")
    merged = merge.merge(lines, steps, decisions)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    # The lines of hunks come from an explode, whose size Spark does not know.
    assert "BroadcastHashJoin" not in plan.split("SortAggregate")[0] and plan.count("SortMergeJoin") >= 3
    assert [r.merged for r in merged.collect()] == ["a\nx\nc\n"]


def test_quality(spark, make_lines):
    lines = make_lines({"p": (["a", "", "c"], ["a", "c"])})
    schema = "pair_id string, old_line int, new_line int"
    golden = spark.createDataFrame([("p", 1, 1), ("p", 2, 2), ("p", 3, 2), ("p", None, 9)], schema)
    mapping = spark.createDataFrame([("p", 1, 1), ("p", 3, 1)], schema)
    (row,) = quality(mapping, golden, lines).collect()
    assert (row.found, row.expected, row.hits, row.precision, row.recall, row.f1) == (2, 2, 1, 0.5, 0.5, 0.5)
