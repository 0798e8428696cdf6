"""Toxicity of texts: character n-grams, naive Bayes log-count ratios, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetrace.llm.common import send_by_value, whole
from linetrace.session import checkpointed

send_by_value(__name__)

SIZES = (4, 5, 6)
HASH_BITS = 20
#: Bound of the training sample: so many labelled rows of each class at most.
CLASS_ROWS = 4000
#: N-grams the classifier sees: those with the largest scaled log-count ratio.
CHOSEN = 2000
SMOOTHING = 1.0
RIDGE = 0.01
THRESHOLD = 0.7
_CHUNK = 1 << 20
#: ASCII as the n-grams see it: small letters and digits, all else a blank.
_FOLDED = np.array([ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)] + [128], np.uint64)


def ngram_ids(text: bytes, mark: np.ndarray) -> np.ndarray:
    """Sorted hash buckets of the character n-grams of a whole text, each once.

    A-Z are lower-cased, ASCII signs and blanks are one sign. ``mark`` is a table of false flags, one for each bucket, that is
    left as it was found. Long texts go through in overlapping chunks.
    """
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    points = _FOLDED[np.minimum(points, 128).astype(np.int64)] + np.where(points >= 128, points - 128, 0).astype(np.uint64)
    longest = max(SIZES)
    for start in range(0, len(points), _CHUNK):
        part = points[start : start + _CHUNK + longest - 1]
        for size in SIZES:
            if len(part) < size:
                continue
            n = len(part) - size + 1
            h = np.full(n, size, np.uint64)
            for k in range(size):
                h = (h ^ part[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mark[(h >> np.uint64(64 - HASH_BITS)).astype(np.int64)] = True
    ids = np.flatnonzero(mark)
    mark[ids] = False
    return ids


def ngrams(text: Column) -> Column:
    @F.pandas_udf("array<int>")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mark = np.zeros(1 << HASH_BITS, bool)
        for texts in batches:
            yield pd.Series([ngram_ids(t, mark).astype(np.int32) for t in texts])

    return of_texts(whole(text).cast("binary"))


class Model:
    """Weights of the n-gram buckets, and the intercept."""

    def __init__(self, ids: list[int], weights: list[float], intercept: float):
        self.table = np.zeros(1 << HASH_BITS, np.float32)
        self.table[ids] = weights
        self.intercept = intercept

    def score(self, text: Column) -> Column:
        """Probability of label 1; an empty text gets what the intercept says."""
        table, intercept = self.table, self.intercept

        @F.pandas_udf("double")
        def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            mark = np.zeros(1 << HASH_BITS, bool)
            for texts in batches:
                sums = np.array([float(table[ngram_ids(t, mark)].sum(dtype=np.float64)) for t in texts])
                yield pd.Series(1 / (1 + np.exp(-np.clip(sums + intercept, -40, 40))), dtype="float64")

        return of_texts(whole(text).cast("binary"))


def training_sample(
    documents: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label: str = "toxic",
    class_rows: int = CLASS_ROWS,
) -> DataFrame:
    """``(text, label)`` of the ``class_rows`` marks of each label with the least id hash.

    ``allowed`` restricts the marks, for instance to ids that are not held out. A document
    with several marks counts with the highest. Null ids, labels other than 0 and 1
    and null texts are not used.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    if allowed is not None:
        marks = marks.where(allowed)
    marks = marks.groupBy(F.col(id_column).alias("marked_id")).agg(F.max(label).cast("int").alias("label"))
    order = F.xxhash64("marked_id")
    parts = [marks.where(f"label = {k}").orderBy(order, "marked_id").limit(class_rows) for k in (0, 1)]
    chosen = checkpointed(parts[0].union(parts[1]))
    texts = documents.select(F.col(f"`{id_column}`").alias("marked_id"), F.col(f"`{text_column}`").alias("text"))
    return texts.where("text is not null").join(chosen, "marked_id").select("text", "label")


def fit(sample: DataFrame, chosen: int = CHOSEN) -> Model:
    """Fit on a bounded table of ``(text, label)``.

    Every n-gram gets a naive Bayes ratio: log of its smoothed share among the presences
    in label 1 against label 0. The ``chosen`` n-grams with the largest ratio, weighed by
    the root of how many rows hold them, are features: presence times ratio. A
    ridge-penalised logistic regression weighs them, both labels counting alike. With one label missing the
    score is the smoothed share of label 1 for every text.
    """
    sample = checkpointed(sample.select("label", ngrams(F.col("text")).alias("ids")))
    totals = dict(sample.groupBy("label").count().collect())
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    prior = (n1 + SMOOTHING) / (n0 + n1 + 2 * SMOOTHING)
    if not n0 or not n1:
        return Model([], [], float(np.log(prior / (1 - prior))))
    # At most one row for each hash bucket.
    counts = (
        sample.select("label", F.explode("ids").alias("id"))
        .groupBy("id")
        .agg(F.sum("label").alias("in1"), F.count("*").alias("all"))
        .where(F.col("all") >= 3)
    )
    sums = counts.agg(F.sum("in1").alias("p"), F.sum("all").alias("a"), F.count("*").alias("v")).first()
    if not sums.v:
        return Model([], [], float(np.log(prior / (1 - prior))))
    share1 = (F.col("in1") + SMOOTHING) / F.lit(sums.p + SMOOTHING * sums.v)
    share0 = (F.col("all") - F.col("in1") + SMOOTHING) / F.lit(sums.a - sums.p + SMOOTHING * sums.v)
    ratios = counts.select("id", "all", F.log(share1 / share0).alias("ratio"))
    best = ratios.orderBy(F.desc(F.abs("ratio") * F.sqrt("all")), "id").limit(chosen).collect()
    best = sorted((r.id, r.ratio) for r in best)
    ids, ratio = [i for i, _ in best], [r for _, r in best]
    held = F.array(*[F.lit(i) for i in ids])
    vectors = sample.select("label", F.array_intersect("ids", held).alias("ids")).select(
        F.col("label").cast("double").alias("label"),
        _dense(F.col("ids"), ids, ratio).alias("features"),
        F.when(F.col("label") == 1, (n0 + n1) / (2.0 * n1)).otherwise((n0 + n1) / (2.0 * n0)).alias("weight"),
    )
    learner = LogisticRegression(regParam=RIDGE, maxIter=60, standardization=False, weightCol="weight")
    model = learner.fit(vectors)
    weights = [float(w) * r for w, r in zip(model.coefficients.toArray(), ratio)]
    return Model(ids, weights, float(model.intercept))


def _dense(present: Column, ids: list[int], ratio: list[float]) -> Column:
    @F.pandas_udf("array<double>")
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, scale = np.array(ids), np.array(ratio)
        for batch in batches:
            yield pd.Series([np.where(np.isin(known, np.asarray(p)), scale, 0.0) for p in batch])

    return array_to_vector(rows(present))


def scored(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every row, nulls and empty texts included.

    ``predicted`` is 1 from a score of ``THRESHOLD`` on. Repeated rows stay rows; other
    columns are not looked at; no rows give no rows.
    """
    rows = documents.select(
        F.col(f"`{id_column}`").alias("doc_id"), model.score(F.col(f"`{text_column}`")).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
