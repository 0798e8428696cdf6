"""Per-line columns: normal forms, tokens, fingerprint and string measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# ASCII punctuation removed by the structural normal form (braces stay).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`|~"
# White space as the Unicode-aware `\s`.
WHITE = r"[\s\x1c-\x1f\x85\p{Z}]+"
# Words kept as they are among the structural tokens.
KEYWORDS = (
    "if", "else", "for", "while", "return", "class", "def", "try", "except",
    "finally", "import", "from", "with", "as", "break", "continue", "pass",
    "lambda", "yield", "in", "not", "and", "or",
)
FINGERPRINT_BITS = 64


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also when used inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_key(text: Column) -> Column:
    """The SHA-256 of a text: 32 bytes that stand for it where texts are only compared for equality."""
    return F.unhex(F.sha2(text, 256))


def _collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE, " "))


def normal_line(text: Column) -> Column:
    """Lower case, no punctuation but braces, single blanks."""
    return _collapse(F.translate(F.lower(text), PUNCTUATION, ""))


def folded_line(text: Column) -> Column:
    """Lower case, single blanks, punctuation kept.

    Never null, so no filter has to compute it once more where it is a join key.
    """
    return F.coalesce(_collapse(F.lower(text)), F.lit(""))


def structure(pre: Column) -> Column:
    """Structural tokens of a normal line: keyword, ``NUM`` or ``ID``."""
    words = F.filter(F.split(pre, "[^a-z0-9_]+"), lambda w: w != "")
    return F.transform(
        words,
        lambda w: F.when(w.isin(*KEYWORDS), w)
        .when(w.rlike("^[0-9]+$"), F.lit("NUM"))
        .otherwise(F.lit("ID")),
    )


def structure_string(pre: Column) -> Column:
    return F.array_join(structure(pre), " ")


def words(text: Column) -> Column:
    """Runs of letters, digits and underscores, case kept."""
    return F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+)"), 1)


def _token_hash(token: str) -> str:
    half = "cast(conv(substr(md5({t}), {at}, 8), 16, 10) as bigint)"
    high, low = half.format(t=token, at=1), half.format(t=token, at=9)
    return f"(shiftleft({high}, 32) | {low})"


def fingerprint(tokens: str) -> Column:
    """SimHash of the array column ``tokens``; no tokens give 0.

    Every token votes on every bit with the bit of its 64-bit hash (first two
    md5 words). A token with more than half of the votes decides all bits alone,
    which covers nearly all lines without counting.
    """
    vote = "s + if((shiftrightunsigned(h, b) & 1L) = 1L, 1, -1)"
    count = f"aggregate(hs, 0, (s, h) -> {vote})"
    bits = (
        f"aggregate(sequence(0, {FINGERPRINT_BITS - 1}), 0L,"
        f" (x, b) -> x | if({count} > 0, shiftleft(1L, b), 0L))"
    )
    hashes = f"transform({tokens}, t -> {_token_hash('t')})"
    identifier = _token_hash("'ID'")
    # Never null, so no filter has to compute it once more where it is a join key.
    return F.expr(
        f"coalesce(case when size({tokens}) = 0 then 0L"
        f" when 2 * size(filter({tokens}, t -> t = 'ID')) > size({tokens}) then {identifier}"
        f" else aggregate(array({hashes}), 0L, (x0, hs) -> {bits}) end, 0L)"
    )


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def longest(a: Column, b: Column) -> Column:
    return F.greatest(F.length(a), F.length(b))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein over code points.

    When one string starts with the other the distance is what is left over.
    """
    return F.when(
        F.startswith(a, b) | F.startswith(b, a), F.abs(F.length(a) - F.length(b))
    ).otherwise(F.levenshtein(a, b))


def edit_distance_within(a: Column, b: Column, limit: Column) -> Column:
    """The edit distance, or null when it is above ``limit``.

    The banded form only pays while the band is narrow.
    """
    narrow = limit * 2 < F.greatest(F.length(a), F.length(b))
    banded = F.call_function("levenshtein", a, b, limit)
    return let(
        F.when(narrow, banded).otherwise(edit_distance(a, b)),
        lambda d: F.when((d >= 0) & (d <= limit), d),
    )


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 1 for two empty strings."""
    return (
        F.when((a == "") & (b == ""), F.lit(1.0))
        .when((a == "") | (b == ""), F.lit(0.0))
        .otherwise(F.lit(1.0) - edit_distance(a, b) / longest(a, b))
    )


def distance(a: Column, b: Column) -> Column:
    """Edit distance / longer length; 0 for equal strings, 1 when one is empty."""
    return (
        F.when(a == b, F.lit(0.0))
        .when((a == "") | (b == ""), F.lit(1.0))
        .otherwise(edit_distance(a, b) / longest(a, b))
    )


# Fixed groups of characters for the overlap bound; all others form one more group.
# Any grouping is right, finer ones only prune more.
_GROUPS = (
    "e", "a", "i", "o", "u", "n", "r", "s", "t", "l", "d", "h", "c", "m", "p", "g",
    " ", "0123456789", "bfvwy",
)


def profile(text: str) -> Column:
    """How many characters of a column fall in each group, as a struct ``c0, c1, ...``."""
    counts = [f"length({text}) - length(translate({text}, '{g}', '')) as c{k}" for k, g in enumerate(_GROUPS)]
    rest = f"length(translate({text}, '{''.join(_GROUPS)}', '')) as c{len(_GROUPS)}"
    return F.expr(f"struct({', '.join([*counts, rest])})")


def overlap_bound(a: str, b: str) -> Column:
    """No alignment of two texts pairs up more equal characters than this.

    ``a`` and ``b`` are names of ``profile`` columns.
    """
    return F.expr(" + ".join(f"least({a}.c{k}, {b}.c{k})" for k in range(len(_GROUPS) + 1)))


def bag(tokens: Column) -> Column:
    """Token counts of an array as a map, by runs in the sorted array."""

    def counts(ordered: Column, starts: Column) -> Column:
        return F.map_from_arrays(
            F.transform(starts, lambda p: F.get(ordered, p)),
            F.transform(
                starts, lambda p, k: F.coalesce(F.get(starts, k + 1), F.size(ordered)) - p
            ),
        )

    def from_ordered(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda p: (p == 0) | (F.get(ordered, p) != F.get(ordered, p - 1)),
        )
        return let(starts, lambda s: counts(ordered, s))

    return F.when(F.size(tokens) == 0, F.create_map().cast("map<string,int>")).otherwise(
        let(F.sort_array(tokens), from_ordered)
    )


def bag_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.map_values(a), F.lit(0), lambda s, v: s + v * v))


def bag_cosine(a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine of two count maps; 1 when both are empty, 0 when one is."""
    products = F.map_zip_with(
        a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) * F.coalesce(y, F.lit(0))
    )
    dot = F.aggregate(F.map_values(products), F.lit(0), lambda s, v: s + v)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(dot / (norm_a * norm_b))
    )
