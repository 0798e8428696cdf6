import random

import pytest
from pyspark.sql import functions as F

from linetrace.sources.blocks import read_lines
from linetrace.sources.documents import chain_neighbours, document_versions
from linetrace.sources.lines import (
    complete_pairs,
    read_golden,
    read_versions,
    split_lines,
    versions_of_pairs,
)
from linetrace.session import numbered


@pytest.mark.parametrize("mode", ["newline", "unicode"])
def test_split_lines(spark, mode):
    texts = ["a\nb\n", "a\nb", "", "\n", "a\r\nb\rc\n\n", "a\x0bb\x85c d", "x\n\ny"]
    pairs = [(str(k), "", t) for k, t in enumerate(texts)]
    versions = versions_of_pairs(spark.createDataFrame(pairs, "pair_id string, old_text string, new_text string"))
    got = {}
    for row in split_lines(versions, mode).where("side = 'new'").orderBy("line_no").collect():
        got.setdefault(row.pair_id, []).append((row.text, row.has_eol))
    for k, text in enumerate(texts):
        plain = text.replace("\r\n", "\n").replace("\r", "\n")
        if mode == "unicode":
            expected = [(t.splitlines()[0], t.splitlines()[0] != t) for t in plain.splitlines(True)]
        else:
            expected = [(t.rstrip("\n"), t.endswith("\n")) for t in plain.split("\n") for t in [t]]
            parts = plain.split("\n")
            closed = parts[-1] == ""
            parts = parts[:-1] if closed else parts
            expected = [(p, closed or i + 1 < len(parts)) for i, p in enumerate(parts)]
        assert got.get(str(k), []) == expected


def test_read_versions(spark, tmp_path):
    (tmp_path / "file1-old.txt").write_bytes(b"one\ntwo\n")
    (tmp_path / "file1-new.txt").write_bytes(b"one\n\xff two\n")
    (tmp_path / "file2-old.txt").write_bytes(b"alone\n")
    versions = read_versions(spark, f"{tmp_path}/*.txt", errors="replace")
    rows = {(r.pair_id, r.side): r.text for r in complete_pairs(versions).collect()}
    assert rows == {("1", "old"): "one\ntwo\n", ("1", "new"): "one\n� two\n"}
    strict = read_versions(spark, f"{tmp_path}/file[12]-old.txt")
    assert {(r.pair_id, r.text) for r in strict.collect()} == {("1", "one\ntwo\n"), ("2", "alone\n")}
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        read_versions(spark, f"{tmp_path}/*.txt").collect()


def test_read_golden(spark, tmp_path):
    (tmp_path / "matchings7.txt").write_text(
        "1 -> 1\n2  -> 3\n3 -> 4, 5\n4,5 -> 6\n6->-\n\n# Unmatched\n(none)\nOLD 8\nNEW 9\n"
    )
    rows = {(r.pair_id, r.old_line, r.new_line) for r in read_golden(spark, f"{tmp_path}/*.txt").collect()}
    assert rows == {
        ("7", 1, 1), ("7", 2, 3), ("7", 3, 4), ("7", 3, 5), ("7", 4, 6), ("7", 5, 6),
        ("7", 6, None), ("7", 8, None), ("7", None, 9),
    }


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_chain_neighbours_over_buckets(spark, bucket):
    numbers = {"a": [0, 1, 2, 5, 6, 11, 30], "b": [3], "c": [4, 29]}
    rows = spark.createDataFrame([(g, n) for g, ns in numbers.items() for n in ns], "g string, n bigint")
    got = {(r.g, r.n): (r.previous, r.following) for r in chain_neighbours(rows, ["g"], "n", bucket).collect()}
    for g, ns in numbers.items():
        for k, n in enumerate(ns):
            expected = (ns[k - 1] if k else None, ns[k + 1] if k + 1 < len(ns) else None)
            assert got[(g, n)] == expected


def test_document_versions(spark):
    rows = [
        (1, "first\nshared\nmore"), (2, "other"), (3, "new head\nshared\nmore"), (4, "shared\n\nother"), (5, None), (6, "\n \n"),
        (7, "shared"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.pair_id, r.side): r.text for r in document_versions(docs).collect()}
    text = dict(rows)
    # 4 shares a line with 3 and one with 2: the later wins; 7 has its only line last in 4.
    assert got == {(str(n), s): text[d] for n, o in ((3, 1), (4, 3), (7, 4)) for s, d in (("new", n), ("old", o))}


def test_versions_of_repeated_and_text_ids(spark):
    rows = [(1, "a\nb"), (1, "b\nc"), (2, "a\nb\nx"), (3, "x\ny"), (None, "a"), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {tuple(r) for r in document_versions(frame).collect()}
    want = {("2", "new", "a\nb\nx"), ("2", "old", "a\nb"), ("3", "new", "x\ny"), ("3", "old", "a\nb\nx")}
    assert got == want
    named = frame.selectExpr("concat('d', doc_id) as doc_id", "text")
    assert {tuple(r) for r in document_versions(named).collect()} == {("d" + p, s, t) for p, s, t in want}


def test_numbers_follow_the_order(spark):
    rows = [(k * 37 % 101, k % 3) for k in range(300)]
    frame = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = [(r.a, r.b) for r in numbered(frame, "n", "a", "b").orderBy("n").collect()]
    assert got == sorted(rows)
    assert numbered(frame.where("a < 0"), "n", "a").count() == 0


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("mode", ["newline", "unicode"])
def test_files_in_blocks(spark, tmp_path, small_blocks, mode):
    rng = random.Random(5)
    pieces = ["a", "line ", "é", "\n", "\r", "\r\n", "\u2028", "\x0b", "\x85", "\n\n", "x" * 50, " ", "\ufeff"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["", "\n", "\r", "\r\n", "\n\r", "a\r\r", "a\x0b", "a\u2028\n", "\ufeff\n", "\ufeffa\n\ufeffb", "no end", "\n" * 200]
    for k, text in enumerate(texts):
        (tmp_path / f"file{k}-new.txt").write_bytes(text.encode() + (b"\xff\xc3\n\xe2\x80" if k % 5 == 0 else b""))
    (tmp_path / "other.txt").write_text("left out\n")
    found = read_lines(spark, str(tmp_path), mode, "replace")
    assert found.where("pair_id = '51'").count() == 200
    want = split_lines(read_versions(spark, str(tmp_path), "replace"), mode)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_blocks_are_counted_in_order(spark, tmp_path, small_blocks):
    (tmp_path / "file1-old.txt").write_bytes(b"".join(b"%d\n" % k for k in range(1, 5001)))
    (tmp_path / "file1-new.txt").write_bytes(b"")
    found = read_lines(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 100
    assert found.where("text = line_no and has_eol").count() == 5000 == found.count()
    (tmp_path / "file2-old.txt").write_bytes(b"\xff\n")
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        read_lines(spark, str(tmp_path)).collect()
