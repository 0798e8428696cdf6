"""Column helpers the operators of this package share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: words are the runs between these.
WHITE = r"[\x20\x09-\x0D]+"
#: ``A-Z`` and their small letters; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def send_by_value(module: str) -> None:
    """Functions of the module travel to executors whole: these need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def whole(text: Column) -> Column:
    """The text; an empty one for null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def pieces(text: Column, separator: str) -> Column:
    """What stands between the separators, empty pieces left out."""
    return F.array_remove(F.split(text, separator), "")


def white_words(text: Column) -> Column:
    return pieces(whole(text), WHITE)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text where the text itself is too long to shuffle."""
    return F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def packed(df: DataFrame, **computed: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``row`` beside the computed ones.

    Whatever names the input has, they cannot clash with those of an operator;
    ``select("row.*")`` brings them back.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(row, *[c.alias(n) for n, c in computed.items()])
