"""Every operator against plain loops, on odd rows: nulls, empties, long texts, repeats, clashing names."""

import hashlib
import os
import random
import zlib
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from linetrace.session import checkpointed  # noqa: E402
from linetrace.llm import (  # noqa: E402
    components,
    decontaminate,
    line_dedup,
    mixing,
    pii,
    quality,
    queries,
    sharding,
    simhash,
    toxicity,
    training_order,
    url_filter,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " words string, row string, size int, key string, h1 int, hash int, print int, n_words string"
)
PASSAGE = "one two three four five six seven eight nine ten eleven twelve Thirteen fourteen fifteen sixteen"


def odd_texts():
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "été", "ÉTÉ", "naïve", "x1", "42", "delta!", "the", "of", "and", "a|b"]
    prose = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(900)) for _ in range(n))
    base = prose(80)
    return [
        None, "", " \t\n\r\x0b\x0c ", "word", "two words", "\n\n", base, base, base + " tail", base.upper(),
        prose(60) + "\n" + PASSAGE + ".\n" + prose(20), PASSAGE.replace(" ", "\n"), "tiny item", "the TINY; item here " * 3,
        "same line\n" * 30, "dup words here " * 40, "### $$$ " * 40, prose(3000), "a" * 30000, "é" * 500, prose(55),
        "mail bob@example.com or +1 (923) 555-9664, ip 10.0.0.255 and 999.1.1.1, card 4111 1111 1111 1111.",
        "é a.b@c.d_e@f.g 1.2.3.4.5.6.7.8 +12345678 4111-1111-1111-1112 " + prose(60), "..x@y.z@q.w +1 2", prose(70) + " idiot",
    ]


def odd_rows():
    texts = odd_texts()
    rows = []
    for k, text in enumerate(texts):
        source = [None, "a", "b", "ä", "z"][k % 5]
        rows.append((k, text, "en" if k % 2 else None, source, None, "w", "r", 1, None, 2, 3, 4, "n"))
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def repeated(odd):
    """Rows twice, and some without an id."""
    return odd.union(odd).union(odd.withColumn("doc_id", F.lit(None).cast("bigint"))).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PASSAGE), (2, "Tiny item"), (3, None), (4, ""), (5, "..."), (None, PASSAGE), (6, PASSAGE[4:] + " more"), (7, "word")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (9, 8), (None, 4), (20, 21), (2, 1)] + [(k, k + 1) for k in range(100, 160)]
    found = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    roots = {r.node: r.root for r in found.collect()}
    assert {k: roots[k] for k in (1, 2, 3, 8, 9, 20, 21)} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 20: 20, 21: 20}
    assert {roots[k] for k in range(100, 161)} == {100} and len(roots) == 68
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash(odd, none):
    found = simhash.near_duplicates(odd)
    got = {(r.doc_id, f"{r.print & (2**64 - 1):016x}", r.component_id) for r in found.collect()}
    assert got == set(plain.simhash_components(texts_of(odd)))
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash_links_by_both_ways(spark, crowd):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        prints |= {p ^ 1 << rng.randrange(64), p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), p ^ 7 << rng.randrange(60)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.linked_prints(spark.createDataFrame(signed, "print bigint"), 2, crowd)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    got = Counter(roots.values())
    least = {p: p for (p,) in signed}
    for _ in range(len(signed)):
        new = {p: min(least[q] for q in least if near(p, q)) for p in least}
        if new == least:
            break
        least = new
    assert got == Counter(v for v in least.values() if list(least.values()).count(v) > 1)


def test_near_duplicates_keep_one(repeated, none):
    kept = texts_of(simhash.without_near_duplicates(repeated))
    want = {c for _, _, c in plain.simhash_components(odd_texts_with_ids())}
    assert sorted(d for d, _ in kept) == sorted(want)
    lone = texts_of(simhash.without_near_duplicates(repeated.where("doc_id is null")))
    assert len(lone) == len(want)
    assert simhash.without_near_duplicates(none).columns == none.columns


def test_near_duplicates_lose_no_text(spark):
    a, b = "the first text of three words and more", "another one that is not near it at all"
    schema = "doc_id bigint, text string, `print` int, `a.b` string"

    def kept(*rows):
        frame = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], schema).repartition(3)
        out = simhash.without_near_duplicates(frame)
        assert out.columns == frame.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert kept((1, a), (2, a), (2, b)) == [(1, a), (2, b)]
    assert kept((7, a), (7, b)) == [(7, b), (7, a)]
    assert kept((7, b), (7, b), (7, a), (9, a), (None, b)) == [(7, b), (7, a)]
    assert kept((None, a), (None, a), (None, b), (3, None), (4, "")) == sorted([(None, a), (None, b), (3, None)], key=str)
    assert simhash.near_duplicates(spark.createDataFrame([(1, a)], "`x.id` bigint, `x.text` string"), "x.id", "x.text").count() == 1


def odd_texts_with_ids():
    return [(r[0], r[1]) for r in odd_rows()]


def test_contamination(odd, repeated, none, items):
    bench = [(r.item_id, r.text) for r in items.collect()]
    want = plain.contamination(texts_of(odd), bench)
    found = decontaminate.contamination(odd, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("n"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("sha"), decontaminate.is_contaminated().alias("bad"))
    assert sorted(map(tuple, found.collect())) == sorted(want)
    clean = {w[0] for w in want if not w[-1]}
    kept = Counter(d for d, _ in texts_of(decontaminate.decontaminated(repeated, items)))
    assert {d: n for d, n in kept.items() if d is not None} == {d: 2 for d in clean} and kept[None] == len(clean)
    assert decontaminate.decontaminated(none, items).count() == 0
    assert decontaminate.decontaminated(odd, items.where("item_id < 0")).count() == len(want)


def test_long_items_alone(odd, spark):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    want = plain.contamination(texts_of(odd), [(1, PASSAGE)])
    found = decontaminate.contamination(odd, items).select("doc_id", "n_words", "n_hit")
    assert sorted(map(tuple, found.collect())) == sorted(w[:3] for w in want)


def test_quality(odd, repeated, none):
    found = quality.quality_report(odd, audit=True).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.isnull("rejected_by").alias("kept"))
    want = [(d, *plain.quality(t), plain.quality_kept(t)) for d, t in texts_of(odd)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    kept = Counter(d for d, _ in texts_of(quality.quality_filter(repeated)))
    assert {d: n for d, n in kept.items() if d is not None} == {w[0]: 2 for w in want if w[-1]}
    assert quality.quality_filter(none).count() == 0 and quality.quality_filter(odd).columns == odd.columns


def test_quality_order_prefers_rejection_per_cost(odd):
    order = quality.cascade_order(odd)
    assert {r.name for r in order} == {r.name for r in quality.RULES}
    assert order[0].name in ("short", "repeats", "symbols", "capitals", "lines", "word_length")


def sizes_by_source(df):
    out = defaultdict(int)
    for r in df.select("source", "text").collect():
        out[r.source] += len(plain.WHITE_WORD.findall(r.text or ""))
    return out


def test_mixing(repeated, none):
    text = F.col("text")
    mixed = mixing.mix(repeated, F.col("source"), mixing.n_words(text), mixing.random_key(F.col("doc_id"), text))
    rows = mixed.select("row.source", "size", "source_size", "target", "taken").collect()
    sizes = sizes_by_source(repeated)
    want = plain.mix_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    out = mixing.mixed_documents(repeated)
    assert out.columns == repeated.columns and sizes_by_source(out) == {s: t for s, t in taken.items() if t}
    assert mixing.mixed_documents(none).count() == 0


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b c ", 2), ("a b", 1), ("\n\tx y z", 1)], "t string, k int")
    got = [r[0].split() for r in df.select(mixing.first_words(F.col("t"), F.col("k"))).collect()]
    assert got == [["a", "b"], ["a"], ["x"]]


@pytest.mark.parametrize("part_rows", [1 << 18, 3])
def test_sharding(repeated, none, part_rows):
    found = sharding.shuffled_shards(repeated, shards=7, part_rows=part_rows).select("row.*", "shard", "slot")
    slots, rows = defaultdict(list), found.collect()
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter(r.text for r in rows) == Counter(r.text for r in repeated.collect())
    assert sharding.shuffled_shards(none).count() == 0


def test_communication_matrix():
    matrix = sharding.communication_matrix([10, 0, 30, 7], [12, 12, 12, 11], 1)
    assert [sum(x) for x in matrix] == [10, 0, 30, 7] and [sum(x) for x in zip(*matrix)] == [12, 12, 12, 11]
    draw = random.Random(2)
    mean = sum(sharding.hypergeometric(draw, 30, 70, 20) for _ in range(4000)) / 4000
    assert abs(mean - 6) < 0.15


def test_personal_data(odd, repeated, none):
    found = pii.personal_data(odd, models={}).select("row.doc_id", "base", pii.span_list("spans").alias("spans"))
    want = {d: plain.personal_data(t) for d, t in texts_of(odd)}
    for r in found.collect():
        assert r.spans == want[r.doc_id][1]
        assert tuple(sum(s.name == k for s in r.base) for k in pii.KINDS) == want[r.doc_id][0]
    assert pii.personal_data(repeated).count() == repeated.count() and pii.personal_data(none).count() == 0


def test_personal_data_learns_other_forms(spark):
    rng = random.Random(4)
    number = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = [f"please call phone +1 {number()} today" for _ in range(300)]
    texts += [f"part {rng.randrange(10**9, 10**10)} in stock" for _ in range(300)]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    models = pii.fit(train)
    assert pii.KINDS.index("phone") in models
    rows = spark.createDataFrame([("please call phone 00 1 (345) 555-1234 today",), ("part 1234567890 in stock",)], "text string")
    got = pii.personal_data(rows, models=models).select("row.text", "base", "spans", pii.redacted("row.text", "spans").alias("out")).collect()
    assert all(not r.base for r in got)
    assert next(r.out for r in got if r.text[0] == "p" and "part" in r.text) == "part 1234567890 in stock"


def test_personal_data_adds_common_other_forms(spark):
    rng = random.Random(8)
    number = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    texts = [f"please call phone +1 {number()} today" for _ in range(300)]
    texts += [f"please call phone 00 1 {number()} today" for _ in range(300)]
    texts += [f"part {rng.randrange(10**9, 10**10)} in stock" for _ in range(300)]
    models = pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows = spark.createDataFrame([(texts[300],), (texts[600],)], "text string")
    got = pii.personal_data(rows, models=models).select("row.text", "base", pii.redacted("row.text", "spans").alias("out"))
    assert {r.text: r.out for r in got.collect() if not r.base} == {texts[300]: "please call phone [phone] today", texts[600]: texts[600]}


def _card(rng, good):
    digits = [rng.randrange(10) for _ in range(15)]
    doubled = [d * 2 - 9 * (d > 4) if k % 2 == 0 else d for k, d in enumerate(digits)]
    last = -sum(doubled) % 10
    return "".join(map(str, [*digits, last if good else (last + rng.randrange(1, 10)) % 10]))


def test_personal_data_planted_forms(spark):
    """Other forms are added, look-alikes are not."""
    rng = random.Random(15)
    part = lambda: rng.randrange(1, 255)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    phone = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    dotted = lambda c: ".".join(c[k : k + 4] for k in (0, 4, 8, 12))
    base = [lambda: f"mail {name()}@{name()}.example.com now", lambda: f"host {part()}.{part()}.{part()}.{part()} up",
            lambda: f"pay card {_card(rng, True)} at once", lambda: f"call phone +1 {phone()} today"]
    other = [lambda: f"mail {name()} (at) {name()} (dot) com now", lambda: f"host {part()} . {part()} . {part()} . {part()} up",
             lambda: f"pay card {dotted(_card(rng, True))} at once", lambda: f"{_card(rng, True)} 17 is paid by card",
             lambda: f"call phone 00 1 {phone()} today"]
    decoy = [lambda: f"we met {name()} at {name()}.end of day", lambda: f"build {rng.randrange(256, 999)}.{rng.randrange(256, 999)}.{part()}.{part()} out",
             lambda: f"pay card {dotted(_card(rng, False))} at once", lambda: f"order {_card(rng, False)} sent", lambda: f"part {rng.randrange(10**9, 10**10)} left"]
    made = [(kind, forms[k]()) for _ in range(150) for kind, forms in enumerate((base, other, decoy)) for k in range(len(forms))]
    found = pii.personal_data(spark.createDataFrame(made, "form int, text string").repartition(3))
    got = found.select("row.form", "row.text", (F.size("spans") - F.size("base")).alias("added")).collect()
    caught = [r.added > 0 for r in got if r.form == 1]
    decoys = [r.added > 0 for r in got if r.form == 2]
    assert len(caught) == 750 and sum(caught) >= 0.9 * len(caught)
    assert sum(decoys) < 0.05 * len(decoys)
    # The model follows the content, not how the rows are dealt out.
    again = pii.personal_data(spark.createDataFrame(made[::-1], "form int, text string").repartition(5))
    as_set = lambda df: {(r.text, r.spans) for r in df.select("row.text", pii.span_list("spans").alias("spans")).collect()}
    assert as_set(found) == as_set(again)


def test_toxicity(spark, odd, none):
    rng = random.Random(6)
    words = ["river", "stone", "cloud", "house", "green", "paper"]
    text = lambda bad: " ".join(rng.choice(words) for _ in range(40)) + (" worthless moron" if bad else "")
    rows = [(k, text(k % 4 == 0), int(k % 4 == 0)) for k in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.training_sample(docs, labels, F.col("doc_id") % 3 != 1))
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert all(got[k].predicted == bad for k, _, bad in rows if k % 3 == 1)
    scores = [r.score for r in toxicity.scored(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.scored(none, model).count() == 0
    unknown = toxicity.fit(toxicity.training_sample(docs, labels.where("toxic = 0")))
    assert all(r.predicted == 0 for r in toxicity.scored(docs, unknown).collect())


RULES = queries.URL_RULES


def test_urls(spark):
    urls = [
        None, "", "no scheme", "HTTP://WWW.Example.ORG/es/1?x#y", "http://a.example.org/en/12", "http://a.example.org/en/2",
        "http://x.com/de/1", "http://x.com/DE/1", "http://x.com", "http://x.com?q/de/", "http://com/fr/", "http://xcom/fr/1",
        "http://x.net/a//b/", "http://h/" + "s/" * 3000, "ftp://u:p@h:80#f", "://only/path",
    ]
    rows = [(k, u) for k, u in enumerate(urls * 2)] + [(None, "http://x.com/de/9")]
    rows += [(100 + k, f"http://y.com/{lang}/{k}") for k in range(60) for lang in ("de", "fr", "en")]
    pages = spark.createDataFrame([(i, u, "t", "h", 1) for i, u in rows], "page_id bigint, url string, template string, host string, n int")
    found = url_filter.judged_urls(pages, RULES)
    got = Counter((r.page_id, r.host, r.path, r.rule) for r in found.select("row.page_id", "host", "path", "rule").collect())
    assert got == Counter((i, *plain.judged(u, [(r.host, r.path) for r in RULES])) for i, u in rows)
    verdicts = {(r.host, r.path.split("/")[1] if r.path else ""): r.verdict for r in found.collect()}
    assert verdicts["y.com", "de"] == "block" and verdicts["y.com", "fr"] == "allow"
    assert url_filter.judged_urls(pages.where("page_id < -1"), RULES).count() == 0


def test_templates_reject_by_purity(spark):
    rows = [("h", f"/bad/{k}", 1 if k % 2 else None) for k in range(60)] + [("h", f"/good/{k}", 0 if k % 2 else None) for k in range(60)]
    tree = url_filter.template_tree(spark.createDataFrame(rows, "host string, path string, label int"))
    rate = {r.template: r.rate for r in tree.collect()}
    assert rate["h/bad/*/$"] > 0.9 and rate["h/good/*/$"] < 0.1


def test_small_and_deep_branches_stand_apart(spark):
    rows = [("h", f"/s{s}/{k}", int(s % 2 == 0) if k < 6 else None) for s in range(60) for k in range(8)]
    rows += [("g", f"/big/{k}", 0 if k % 2 else None) for k in range(1500)] + [("g", f"/bad/{k}", 1 if k % 2 else None) for k in range(20)]
    rows += [("d", f"/a/b/c/d/e/f/g/{w}/{k}", (w == "bad") if k % 2 else None) for w in ("bad", "good") for k in range(40)]
    rows = [(h, p, None if x is None else int(x)) for h, p, x in rows]
    tree = url_filter.template_tree(spark.createDataFrame(rows, "host string, path string, label int"))
    found = tree.collect()
    assert Counter((r.host, r.path, r.label) for r in found) == Counter(rows)
    rate = {(r.host, r.path): r.rate for r in found}
    assert all((rate["h", f"/s{s}/7"] > 0.6) == (s % 2 == 0) for s in range(60))
    assert rate["g", "/bad/0"] > 0.6 > rate["g", "/big/0"]
    assert rate["d", "/a/b/c/d/e/f/g/bad/0"] > 0.6 > rate["d", "/a/b/c/d/e/f/g/good/0"]


def test_tree_is_the_plain_one(spark):
    rng = random.Random(11)
    words = ["de", "fr", "a", "b", "12", "2024-01-02", "*", "$", "x.html"]
    rows = []
    for _ in range(600):
        path = "".join("/" + rng.choice(words) for _ in range(rng.randrange(9)))
        odds = 0.9 if "/de" in path else 0.1
        rows.append((rng.choice("gh"), path, rng.choice([None, int(rng.random() < odds)])))
    rows += [("none", "/x", None)]
    tree = url_filter.template_tree(spark.createDataFrame(rows, "host string, path string, label int"))
    got = Counter((r.host, r.path, r.label, r.template, round(r.rate, 9), r.labels) for r in tree.collect())
    want = plain.templates(rows, url_filter.DEPTH, url_filter.VARIABLE, url_filter.DISTANCE, url_filter.PRIOR)
    assert got == Counter((*row, t, round(rate, 9), n) for row, (t, rate, n) in zip(rows, want))


def test_sections_without_labels_are_allowed(spark):
    rows = [f"http://h.com/de/{k}" for k in range(40)] + [f"http://h.com/other/{k}" for k in range(40)] * 2
    rows += [f"http://h.com/fr/{k}" for k in range(20)]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(rows)], "page_id bigint, url string")
    found = url_filter.judged_urls(pages, RULES).select("row.url", "verdict").collect()
    assert Counter(r.url for r in found) == Counter(rows)
    assert {r.verdict for r in found if "/de/" in r.url} == {"block"}
    assert {r.verdict for r in found if "/other/" in r.url} == {"allow"}


def test_permutation():
    import numpy as np

    for n in (1, 2, 3, 5, 17, 100, 1000, 99991):
        assert sorted(training_order.permuted(np.arange(n), n).tolist()) == list(range(n))


def test_training_order(odd, none, tmp_path):
    import tiktoken

    order = training_order.training_order(odd, queries.VOCABULARY, queries.WORD_PATTERN, queries.END_OF_TEXT, length=64, shard_rows=50)
    rows = order.collect()
    assert [r.slot for r in sorted(rows, key=lambda r: r.slot)] == list(range(len(rows)))
    assert all(r.shard == r.slot // 50 and len(r.tokens) == 128 for r in rows)
    tokenizer = training_order.Tokenizer(queries.VOCABULARY, queries.WORD_PATTERN, queries.END_OF_TEXT)
    import numpy as np

    stream = []
    for r in sorted(rows, key=lambda r: r.sequence):
        stream += np.frombuffer(r.tokens, "<u2")[: r.n_tokens].tolist()
    texts, now = [], []
    for t in stream:
        if t == queries.END_OF_TEXT:
            texts.append(tokenizer.encoding.decode(now))
            now = []
        else:
            now.append(t)
    assert Counter(texts) == Counter(t or "" for _, t in texts_of(odd))
    assert isinstance(tokenizer.encoding, tiktoken.Encoding)
    training_order.write_shards(order, str(tmp_path), 64, 50)
    by_slot = {r.slot: r.tokens for r in rows}
    got = training_order.read_slots(str(tmp_path), 45, 20)
    assert [x.tobytes() for x in got] == [by_slot[s] for s in range(45, min(65, len(rows)))]
    written = training_order.written_sequences(odd.sparkSession, str(tmp_path))
    assert sorted((r.shard, r.slot, r.sequence, r.n_tokens, r.tokens_crc32) for r in written.collect()) == sorted(
        (r.shard, r.slot, r.sequence, r.n_tokens, zlib.crc32(r.tokens)) for r in rows
    )
    assert len(list((tmp_path / "shards").glob("shard=*/part-*"))) == -(-len(rows) // 50)
    empty = training_order.training_order(none, queries.VOCABULARY, queries.WORD_PATTERN, queries.END_OF_TEXT)
    assert empty.count() == 0
    training_order.write_shards(empty, str(tmp_path / "none"))
    assert training_order.written_sequences(odd.sparkSession, str(tmp_path / "none")).count() == 0
    assert len(training_order.read_slots(str(tmp_path / "none"), 0, 5)) == 0


@pytest.mark.parametrize("crowd", [64, 1])
def test_line_links(spark, crowd):
    rng = random.Random(9)
    lines = set()
    for _ in range(25):
        line = "".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 45)))
        lines.add(line)
        for _ in range(4):
            chars = list(line)
            for _ in range(rng.randrange(1, 4)):
                at = rng.randrange(len(chars))
                [lambda: chars.pop(at), lambda: chars.insert(at, "x"), lambda: chars.__setitem__(at, "y")][rng.randrange(3)]()
            lines.add("".join(chars))
    lines |= {"a" * n for n in range(20, 26)} | {"ab" * 12, "ab" * 12 + "a"}
    lines = sorted(x for x in lines if len(x) >= 20)
    schema = "h1 bigint, h2 bigint, line string, n int, copies bigint"
    df = spark.createDataFrame([(k, -k, x, len(x), 1 + k % 3) for k, x in enumerate(lines)], schema)
    got = [(r.a.h1, r.b.h1) for r in line_dedup.linked_lines(df, 2, 20, crowd).collect()]
    want = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if plain.edits(lines[i], lines[j]) <= 2]
    assert {tuple(sorted(p)) for p in got} <= set(want)
    assert plain.components(len(lines), got) == plain.components(len(lines), want)


@pytest.mark.parametrize("limits", [line_dedup.LIMITS, ((2, 20),)])
def test_line_classes_of_copies_and_short_lines(spark, limits):
    """Near copies without their original, rules of dashes, short lines: classes by comparing all lines."""
    rng = random.Random(12)
    base = "the quick brown fox jumps over the lazy dog and runs"

    def changed(line, edits):
        chars = list(line)
        for _ in range(edits):
            at = rng.randrange(len(chars))
            rng.choice([lambda: chars.pop(at), lambda: chars.insert(at, rng.choice("xyz")), lambda: chars.__setitem__(at, "#")])()
        return "".join(chars)

    lines = {changed(base, rng.randrange(1, 3)) for _ in range(120)} | {c * n for c in "-=a" for n in range(4, 30)}
    lines |= {changed("tiny line of it", 1) for _ in range(25)} | {f"Item {k}" for k in range(20)} | {f"Chapter {k} of it" for k in range(60)}
    lines |= {"nineteen chars line", "nineteen chars, line", "nineteen char, line", "ab" * 9, "ab" * 10, "ab" * 11 + "c"}
    lines = sorted(x for x in lines if plain.WHITE_WORD.search(x))
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id bigint, text string")
    found = {r.doc_id: r.class_doc_id for r in line_dedup.line_classes(frame, limits=limits).collect()}

    def linked(x, y):
        edits = max((e for e, least in limits if max(len(x), len(y)) >= least), default=0)
        return abs(len(x) - len(y)) <= edits and plain.edits(x, y) <= edits

    pairs = [(i, j) for i in range(len(lines)) for j in range(i) if linked(lines[i], lines[j])]
    assert found == plain.components(len(lines), pairs)


def test_links_grow_with_near_copies_only(spark):
    """Links of one group grow with its lines, not with their pairs."""
    words = [f"word{k}" for k in range(9)]

    def links(count):
        lines = {f"{' '.join(words)} number {k:05d}" for k in range(count)} | {" ".join(words) + " number 00000"}
        rows = [(k, -k, x, len(x), 1) for k, x in enumerate(sorted(lines))]
        return line_dedup.linked_lines(spark.createDataFrame(rows, "h1 bigint, h2 bigint, line string, n int, copies bigint"), 2, 20).count()

    assert links(600) < 3 * links(300)


def test_line_classes(odd, repeated, none):
    found = {r.line: r for r in line_dedup.line_classes(repeated).collect()}
    counts = Counter(x for _, t in texts_of(repeated) for x in (t or "").split("\n") if plain.WHITE_WORD.search(x))
    assert {k: r.copies for k, r in found.items()} == counts
    assert line_dedup.line_classes(none).count() == 0


LONG = "a line of some length that stands in many texts"


@pytest.fixture(scope="module")
def lined(spark):
    texts = [f"own line number {k} of one text only\n\n{LONG}\n" + ("x" * (20 + 9 * k)) + f"\n{LONG}" for k in range(50)]
    texts += [LONG + "s", "", None]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(0, texts[0], 2), (None, texts[1], 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, copies int").repartition(4)


@pytest.mark.parametrize("least", [64, 10**9])
def test_line_members_name_every_holder(lined, none, monkeypatch, least):
    monkeypatch.setattr(line_dedup, "HOT_LEAST", least)
    rows = lined.collect()
    want = Counter(
        (r.doc_id, n, hashlib.md5(x.encode()).hexdigest())
        for r in rows for n, x in enumerate((r.text or "").split("\n"), 1) if plain.WHITE_WORD.search(x)
    )
    members = line_dedup.line_members(lined).collect()
    assert Counter((r.doc_id, r.line_no, r.line_md5) for r in members) == want
    copies = Counter(r.line_md5 for r in members)
    assert all(r.copies == copies[r.line_md5] for r in members) and max(copies.values()) > 100
    assert {r.class_doc_id for r in members if r.doc_id == 50} == {0} and line_dedup.line_members(none).count() == 0


def test_without_repeated_lines(lined, none):
    out = line_dedup.without_repeated_lines(lined)
    assert out.columns == lined.columns and line_dedup.without_repeated_lines(none).count() == 0
    got = {(r.doc_id, r.copies): r.text for r in out.collect()}
    assert len(got) == lined.count()
    whole, again = got.pop((0, 1)), got.pop((0, 2))
    assert Counter((whole + "\n" + again).split("\n"))[LONG] == 1
    assert not any(LONG in (t or "") for t in got.values())
    assert got[50, 1] == got[51, 1] == "" and got[52, 1] is None and got[None, 3] == ""


def test_pipeline(spark, odd, items, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {d for d, t in odd_texts_with_ids() if plain.quality_kept(t)}
    want &= {c for _, _, c in plain.simhash_components([x for x in odd_texts_with_ids() if x[0] in want])}
    bench = [(r.item_id, r.text) for r in items.collect()]
    want = {w[0] for w in plain.contamination([x for x in odd_texts_with_ids() if x[0] in want], bench) if not w[-1]}
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = checkpointed(stage(spark, docs, str(tmp_path)))
    assert docs.columns == odd.columns and sorted(r.doc_id for r in docs.collect()) == sorted(want)
    sizes = {d: len(plain.WHITE_WORD.findall(t)) for d, t in odd_texts_with_ids() if d in want}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= want
    words = Counter()
    for r in out:
        words[r.doc_id] += len(plain.WHITE_WORD.findall(r.text))
    by_source = Counter()
    for d, n in sizes.items():
        by_source[odd_rows()[d][3]] += n
    for source, target in plain.mix_targets(by_source).items():
        assert abs(sum(n for d, n in words.items() if odd_rows()[d][3] == source) - target) <= 0.5
    assert all(words[d] <= 2 * sizes[d] for d in words)
    assert sorted((r.shard, r.slot) for r in out) == [
        (s, k) for s, n in sorted(Counter(r.shard for r in out).items()) for k in range(n)
    ]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark", "mixing", "sharding"]


def test_personal_data_fits_all_documents(spark):
    """Every candidate of every document is counted, however many there are."""
    plain_ids = spark.range(60_000).selectExpr("concat('call phone +1 (555) 010-', lpad(id % 10000, 4, '0')) as text")
    others = spark.range(60_000).selectExpr("concat('part ', 1000000000 + id, ' left') as text")
    rows = pii._counted(plain_ids.union(others), "text").where(F.col("kind") == pii.KINDS.index("phone"))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    # A call is proposed in its base form and in a loose one.
    assert counts == {1.0: 120_000, 0.0: 60_000} and rows.count() <= 20


def test_personal_data_model_counts_repeats(spark):
    """A vector that occurs often is one row with its number, and the trees and the cut are those of all rows."""
    texts = [f"call phone +1 (555) 010-{k:04}" for k in range(90)] + [f"part {10**9 + k} left" for k in range(90)]
    once = spark.createDataFrame([(t,) for t in texts], "text string")
    thrice = once.union(once).union(once)
    base, often = pii.fit(once), pii.fit(thrice)
    assert base.keys() == often.keys() and base
    assert all(abs(base[k][1] - often[k][1]) < 1e-3 for k in base)


def test_components_of_few_links_shuffle_nothing(spark, monkeypatch):
    """A round over few links is one part; its components are those of the rounds that are dealt out."""
    rng = random.Random(21)
    made = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(k + 100, k + 101) for k in range(40)] + [(7, 7), (None, 3)]
    links = spark.createDataFrame(made, "a long, b long").repartition(3)
    table = checkpointed(links.where("a > b"))
    plan = components._small_star(components._large_star(components._in_parts(table, 3)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    few = sorted(map(tuple, components.connected_components(links).collect()))
    monkeypatch.setattr(components, "ONE_PART", 0)
    assert few == sorted(map(tuple, components.connected_components(links).collect())) and len(few) > 100
