"""Personal data: loose candidates, boosted trees on format and context, calibrated cuts."""

from __future__ import annotations

from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetrace.llm.common import packed, whole
from linetrace.session import checkpointed

#: Kinds in the order of their spans.
KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the base spans. Possessive repeats and the tests before a match
#: only spare steps back: every text gives the same matches as without them.
_MAIL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of high recall: what could be of the kind, written in some other way. Those of one kind overlap: a
#: number beside another is proposed with and without it.
LOOSE = {
    "email": [
        rf"(?<![{_MAIL}])[{_MAIL}]{{1,64}}+(?:\x20?[\[(]\x20?at\x20?[\])]\x20?|\x20at\x20|\x20?@\x20?)"
        r"[A-Za-z0-9-]{1,63}+(?:(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}+){1,8}+"
    ],
    "ip": [r"(?<![0-9.])[0-9]{1,3}+(?:\x20?[.,]\x20?[0-9]{1,3}+){3}(?![0-9])"],
    "card": [
        r"(?<![0-9A-Za-z])[0-9](?:[\x20./_-]{0,2}+[0-9]){11,18}(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z])[0-9]{12,19}+(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20./_-]{1,2}+[0-9]{4}){3}(?![0-9A-Za-z])",
    ],
    "phone": [r"(?<![0-9A-Za-z])(?:00|\(?[0-9])[\x20()./0-9-]{7,24}[0-9](?![0-9A-Za-z])"],
}
#: A kind can only occur in texts that hold this.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
LOOSE_NEEDS = {"email": r"[@\])]|\x20at\x20", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CONTEXT = 24
FEATURES = (
    "length", "digits", "letters", "marks", "groups", "first_group", "last_group", "brackets",
    "letter_before", "letter_after", "sign_before", "quote_near", "hint", "check",
)
HINTS = {
    "email": "mail|contact|write|reach",
    "ip": "ip|host|server|addr",
    "card": "card|visa|credit|pay|master",
    "phone": "phone|tel|call|fax|mobile|cell",
}
#: The trees of a kind, and the least number of thresholds they choose from for each feature.
TREES, DEPTH, BINS = 10, 3, 32
TREE_SEED = 5
#: A kind adds spans from the greatest score on that so many of its held-out known candidates reach, and not below the
#: score that this share of the held-out negatives reaches.
RECALL = 0.9
DECOYS = 0.02
HELD_OUT_LEAST = 20


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(match: str) -> str:
    return f"regexp_replace({match}, '[^0-9]', '')"


#: Which matches of a base pattern count, in SQL over the match ``x``.
VALID = {
    "email": "true",
    "ip": (
        "forall(split(x, '[.]'), p -> length(trim(leading '0' from p)) <= 3"
        " and cast(concat('0', right(p, 3)) as int) <= 255)"
    ),
    "card": (
        f"length({_digits('x')}) between 12 and 19 and aggregate(split(reverse({_digits('x')}), ''),"
        " named_struct('s', 0, 'k', 0), (a, d) -> named_struct('s', a.s + if(a.k % 2 = 0, int(d),"
        " int(d) * 2 - if(int(d) > 4, 9, 0)), 'k', a.k + 1), a -> a.s) % 10 = 0"
    ),
    "phone": f"length({_digits('x')}) between 9 and 15",
}
#: What must hold for the digits of a candidate ``x``, in whatever form it is written.
CHECK = {
    "email": "true",
    "ip": "forall(regexp_extract_all(x, '[0-9]+', 0), p -> length(p) <= 3 and int(p) <= 255)",
    "card": VALID["card"],
    "phone": VALID["phone"],
}
_NONE = "cast(array() as array<struct<start:int,match:string>>)"


def found(text: str, pattern: str, needs: str, valid: str = "true") -> str:
    """SQL array of ``(start, match)`` of the valid matches, starts in code points from 0.

    Leftmost matches that do not overlap, in order. What stands between the matches
    and the matches themselves give the places; the fold runs only in texts with a valid one.
    """
    return (
        f"if({text} rlike {_quoted(needs)}, transform(array(regexp_extract_all({text}, {_quoted(pattern)}, 0)), m ->"
        f" if(not exists(m, x -> {valid}), {_NONE}, transform(array(split({text}, {_quoted(pattern)}, -1)), g ->"
        f" aggregate(sequence(0, size(m) - 1), named_struct('at', 0, 'out', {_NONE}), (s, i) -> named_struct("
        "'at', s.at + length(g[i]) + length(m[i]),"
        f" 'out', if(exists(array(m[i]), x -> {valid}),"
        " array_append(s.out, named_struct('start', s.at + length(g[i]), 'match', m[i])), s.out)),"
        f" s -> s.out))[0]))[0], {_NONE})"
    )


def _spans(kind: str, place: int, array: str) -> str:
    return (
        f"transform({array}, x -> named_struct('start', x.start, 'kind', {place}, 'name', '{kind}',"
        " 'end', x.start + length(x.match)))"
    )


def base_spans(text: str = "text") -> Column:
    """Valid base matches of all kinds by start, then kind."""
    parts = [
        _spans(kind, place, found(text, BASE[kind], NEEDS[kind], VALID[kind])) for place, kind in enumerate(KINDS)
    ]
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def _features(kind: str) -> str:
    """SQL array of the features of candidate ``x`` in ``text``."""
    before = f"substring(text, greatest(1, x.start + 1 - {CONTEXT}), least(x.start, {CONTEXT}))"
    after = f"substring(text, x.start + 1 + length(x.match), {CONTEXT})"
    runs = "regexp_extract_all(x.match, '[0-9]+', 0)"
    flag = "if({}, 1D, 0D)".format
    values = {
        "length": "double(length(x.match))",
        "digits": f"double(length({_digits('x.match')}))",
        "letters": "double(length(regexp_replace(x.match, '[^A-Za-z]', '')))",
        "marks": "double(length(regexp_replace(x.match, '[A-Za-z0-9]', '')))",
        "groups": f"double(size({runs}))",
        "first_group": f"double(coalesce(length(get({runs}, 0)), 0))",
        "last_group": f"double(coalesce(length(get(reverse({runs}), 0)), 0))",
        "brackets": flag("x.match rlike '[(\\\\[]'"),
        "letter_before": flag(f"{before} rlike '[A-Za-z0-9]$'"),
        "letter_after": flag(f"{after} rlike '^[A-Za-z0-9]'"),
        "sign_before": flag(f"{before} rlike '[=:#$/\\\\\\\\]\\\\s?$'"),
        "quote_near": flag(f"concat(right({before}, 2), left({after}, 2)) rlike '[\"`]'"),
        "check": flag(f"exists(array(x.match), x -> {CHECK[kind]})"),
        "hint": flag(f"lower({before}) rlike '{HINTS[kind]}'"),
    }
    return f"array({', '.join(values[name] for name in FEATURES)})"


def candidates(text: str = "text", base: str = "base") -> Column:
    """Loose spans with features and ``known``: overlapping a base span of their kind.

    The base matches that are valid are candidates too, so that they can be learned from.
    """
    parts = []
    for place, kind in enumerate(KINDS):
        loose = ", ".join(found(text, pattern, LOOSE_NEEDS[kind]) for pattern in LOOSE[kind])
        given = (
            f"transform(filter({base}, b -> b.kind = {place}), b -> named_struct('start', b.start, 'match',"
            f" substring({text}, b.start + 1, b.end - b.start)))"
        )
        parts.append(
            f"transform(concat({loose}, {given}), x -> named_struct('start', x.start, 'kind', {place}, 'name', '{kind}',"
            " 'end', x.start + length(x.match), 'known', exists"
            f"({base}, b -> b.kind = {place} and b.start < x.start + length(x.match) and x.start < b.end),"
            f" 'f', {_features(kind)}))"
        )
    return F.expr(f"concat({', '.join(parts)})")


def _tree_sql(node) -> str:
    if node.numDescendants() == 0:
        return f"{node.prediction()!r}D"
    split = node.split()
    return (
        f"if(c.f[{split.featureIndex()}] <= {split.threshold()!r}D,"
        f" {_tree_sql(node.leftChild())}, {_tree_sql(node.rightChild())})"
    )


def model_sql(model) -> str:
    """The probability a boosted classifier gives candidate ``c``, as a SQL expression."""
    trees = [f"{w!r}D * {_tree_sql(t._java_obj.rootNode())}" for w, t in zip(model.treeWeights, model.trees)]
    return f"1 / (1 + exp(-2 * ({' + '.join(trees)})))"


def _labelled(rows: DataFrame) -> DataFrame:
    """Candidates that can be learned from, with ``label``."""
    check, hint = (F.get("c.f", FEATURES.index(name)) == 1 for name in ("check", "hint"))
    looks_alone = ~check | (~hint & (F.col("c.name") != "card"))
    label = F.when(F.col("c.known"), F.when(check, 1.0)).when(looks_alone, 0.0)
    return rows.withColumn("label", label).where("label is not null")


def _counted(documents: DataFrame, text_column: str) -> DataFrame:
    """``kind, label, f, held, n``: the labelled candidates of all documents, ``n`` of the same features; a third of the texts is held out."""
    texts = documents.select(whole(F.col(f"`{text_column}`")).alias("text")).withColumn("base", base_spans())
    found = texts.select((F.pmod(F.xxhash64("text"), F.lit(3)) == 0).alias("held"), F.explode_outer(candidates()).alias("c"))
    rows = _labelled(found.where("c is not null"))
    return checkpointed(
        rows.groupBy(F.col("c.kind").alias("kind"), "label", F.col("c.f").alias("f"), "held").agg(F.count("*").alias("n"))
    )


def fit(documents: DataFrame, text_column: str = "text") -> dict[int, tuple[str, float]]:
    """Per kind a score as SQL over candidate ``c`` and the cut from which it redacts.

    All candidates of all documents are learned from, counted by their features. Known ones overlap a base span and pass
    their kind's check (Luhn, parts up to 255, number of digits). Negatives are unmatched ones that fail the
    check. One that passes may be the same in another form: it is a negative only where no hint word of its
    kind stands before it, and never for cards, where few numbers pass by chance; the others are left out of the fit.
    Both labels weigh the same. Two thirds of the texts grow the trees, which see the check beside format and
    context. The rest set the cut: the greatest score that ``RECALL`` of the known ones reach, raised to what
    ``DECOYS`` of the negatives reach if that is higher. A kind without candidates of both
    labels, or with fewer than ``HELD_OUT_LEAST`` known ones held out, adds nothing.
    """
    rows = _counted(documents, text_column)
    grown = ~F.col("held")
    totals = rows.where(grown).groupBy("kind").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("vectors"),
        (F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("known"),
    ).collect()
    out = {}
    for total in sorted(totals, key=lambda r: r.kind):
        if total.low == total.high:
            continue
        part = rows.where(F.col("kind") == total.kind)
        # In one order, which the trees depend on; a vector of features is one row, however often it occurs.
        ordered = part.where(grown).orderBy("f", "label")
        weight = F.when(F.col("label") == 1, 0.5 / total.known).otherwise(0.5 / (1 - total.known))
        vectors = ordered.select("label", (weight * F.col("n")).alias("weight"), array_to_vector("f").alias("features"))
        # MLlib looks for thresholds in all rows only while they are no more than the square of the bins.
        bins = max(BINS, isqrt(total.vectors) + 1)
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=TREE_SEED, maxBins=bins, weightCol="weight").fit(vectors)
        score = model_sql(model)
        cut = _cut(part.where("held"), score)
        if cut is not None:
            out[total.kind] = (score, cut)
    return out


def _cut(held: DataFrame, score: str) -> float | None:
    """The cut that the held-out candidates ``f, label``, ``n`` of each, give."""
    scores = held.select("label", "n", F.struct("f").alias("c")).select("label", "n", F.expr(score).alias("s"))
    known, other = (F.when(F.col("label") == label, F.col("s")) for label in (1, 0))
    found = scores.agg(
        F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("n"),
        F.percentile(known, F.lit(1 - RECALL), F.col("n")).alias("reached"),
        F.percentile(other, F.lit(1 - DECOYS), F.col("n")).alias("decoys"),
    ).first()
    if (found.n or 0) < HELD_OUT_LEAST:
        return None
    reached = found.reached - 1e-6
    return reached if found.decoys is None else max(reached, found.decoys + 1e-6)


def personal_data(
    documents: DataFrame, text_column: str = "text", models: dict[int, tuple[str, float]] | None = None
) -> DataFrame:
    """Each row as struct ``row`` with ``base`` and ``spans``.

    Spans are structs ``(start, kind, name, end)`` in code points, end exclusive, by start
    and kind. ``base`` are the valid matches of the base patterns; ``spans`` adds the loose
    candidates that the trees score at their kind's cut or above, highest scores first, then by place,
    that overlap no base span nor an added one. ``models`` defaults
    to ``fit`` on these documents. Null and empty texts have no spans; repeated rows
    stay rows; other columns are carried in ``row``. All work is inside the row.
    """
    models = fit(documents, text_column) if models is None else models
    df = packed(documents, text=whole(F.col(f"`{text_column}`"))).withColumn("base", base_spans())
    if not models:
        return df.select("row", "base", F.col("base").alias("spans"))
    scores = " ".join(f"when {kind} then {score}" for kind, (score, _) in models.items())
    cuts = " ".join(f"when {kind} then {cut!r}D" for kind, (_, cut) in models.items())
    span = "struct<start:int,kind:int,name:string,end:int>"
    df = df.withColumn("candidates", candidates()).withColumn(
        "ranked",
        F.expr(
            "array_sort(filter(transform(filter(candidates, c -> not c.known"
            " and not exists(base, b -> b.start < c.end and c.start < b.end)),"
            f" c -> named_struct('below', -(case c.kind {scores} end), 'start', c.start, 'kind', c.kind, 'name', c.name,"
            f" 'end', c.end)), c -> -c.below >= case c.kind {cuts} end))"
        ),
    )
    df = df.withColumn(
        "extra",
        F.expr(
            f"aggregate(ranked, cast(array() as array<{span}>), (a, c) -> if(exists(a, b -> b.start < c.end and c.start < b.end),"
            " a, array_append(a, named_struct('start', c.start, 'kind', c.kind, 'name', c.name, 'end', c.end))))"
        ),
    )
    return df.select("row", "base", F.expr("array_sort(concat(base, extra))").alias("spans"))


def span_list(spans: str) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.name, s.start, s.end)), ',')")


def redacted(text: str, spans: str) -> Column:
    """The text with each span replaced by its kind in brackets, overlapping ones as one."""
    return F.expr(
        f"aggregate({spans}, named_struct('out', '', 'at', 0), (a, s) -> if(s.start < a.at,"
        " named_struct('out', a.out, 'at', greatest(a.at, s.end)),"
        f" named_struct('out', concat(a.out, substring({text}, a.at + 1, s.start - a.at), '[', s.name, ']'), 'at', s.end)),"
        f" a -> concat(a.out, substring({text}, a.at + 1, length({text}))))"
    )
