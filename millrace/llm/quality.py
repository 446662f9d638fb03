"""Document quality by regularised quadratic discriminant analysis.

Each text becomes a vector of transformed statistics (lengths, shares of repeated words and
lines, shares of capitals, digits and symbols). Per class a mean and a covariance are summed
over the labelled rows by Spark; covariances are shrunk towards the pooled one and then
towards its diagonal. Their Cholesky factors are computed once and turned into column
arithmetic: whitened differences, squared and summed, are Mahalanobis distances, and the
difference of the classes' log densities gives the score.

Only rows outside the held-out fold teach labels, and neither id, language nor source enter
a score. Null and empty texts have the statistics of an empty text and get a score like any
other. With labels of one class only, or none, every score is the share of label 1 (0.5
without labels). Rows keep their number; a row labelled twice counts twice. Statistics are
computed on whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import held_out, whole
from millrace.workspace import materialize

#: Shrinkage of each class covariance towards the pooled one, and of that towards its diagonal.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05
#: Added to variances, in squared units of the statistics.
FLOOR = 1e-4
#: A score from which a document is predicted to have label 1.
THRESHOLD = 0.7


def left_after(text: Column, pattern: str) -> Column:
    """Characters that are left when all matches are taken out."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("double")


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, s0, s1, ...)``: transformed statistics of each text."""
    # The counts sit in a generator's output, so that each is computed once.
    base = docs.select(F.col(key), whole(F.col(text).cast("string")).alias("t"))
    words, lines = F.split("t", r"\s+"), F.split("t", r"\n+")
    parts = base.select(
        key,
        "t",
        F.explode(F.array(F.struct(words.alias("words"), lines.alias("lines")))).alias("p"),
    )
    counts = parts.select(
        key,
        F.length("t").cast("double").alias("n"),
        F.size("p.words").cast("double").alias("w"),
        F.size(F.array_distinct("p.words")).cast("double").alias("dw"),
        F.size("p.lines").cast("double").alias("l"),
        F.size(F.array_distinct("p.lines")).cast("double").alias("dl"),
        left_after(F.col("t"), r"[^\p{Lu}]+").alias("upper"),
        left_after(F.col("t"), r"[^0-9]+").alias("digits"),
        left_after(F.col("t"), r"[\p{L}\p{N}\s.,]+").alias("symbols"),
        left_after(F.col("t"), r"[^.,]+").alias("stops"),
    )
    n, w = F.col("n") + 1, F.col("w") + 1
    made = [
        F.log(n),
        F.log(n / w),
        F.log((F.col("dw") + 1) / w),
        F.log((F.col("dw") + 1) / w) * F.log(w) / 8,
        F.log((F.col("dl") + 1) / (F.col("l") + 1)),
        F.log(w / (F.col("l") + 1)),
        F.sqrt(F.col("upper") / n),
        F.sqrt(F.col("digits") / n),
        F.sqrt(F.col("symbols") / n),
        F.sqrt(F.col("stops") / n),
    ]
    return counts.select(key, *[x.alias(f"s{i}") for i, x in enumerate(made)])


@dataclass
class Discriminant:
    """Per class a mean, the inverse Cholesky factor, and a constant; or a flat score."""

    means: list[np.ndarray]
    whiten: list[np.ndarray]
    constants: list[float]
    share: float

    def score(self, values: list[Column]) -> Column:
        """Probability of label 1."""
        if len(self.means) < 2:
            return F.lit(self.share)
        odds = F.lit(self.constants[1] - self.constants[0])
        for sign, mean, factor in zip((0.5, -0.5), self.means, self.whiten):
            centred = [x - F.lit(float(m)) for x, m in zip(values, mean)]
            for row in range(len(centred)):
                white = sum((c * F.lit(float(f)) for c, f in zip(centred, factor[row, : row + 1])), F.lit(0.0))
                odds = odds + F.lit(sign) * white * white
        bounded = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds))
        return 1 / (1 + F.exp(-bounded))


def fit(known: DataFrame, label: str = "label") -> Discriminant:
    """From rows of statistics with a label 0 or 1; sums are made by Spark, two rows reach the driver."""
    names = [c for c in known.columns if c != label]
    sums = [F.sum(c).alias(f"m_{i}") for i, c in enumerate(names)]
    products = [
        F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p_{i}_{j}") for i in range(len(names)) for j in range(i + 1)
    ]
    rows = {r[label]: r for r in known.groupBy(label).agg(F.count("*").alias("rows"), *sums, *products).collect()}
    counts = [rows[k]["rows"] if k in rows else 0 for k in (0, 1)]
    total = sum(counts)
    share = counts[1] / total if total else 0.5
    size = len(names)
    if min(counts) <= size:
        return Discriminant([], [], [], float(share))
    means, scatters = [], []
    for k in (0, 1):
        mean = np.array([rows[k][f"m_{i}"] for i in range(size)]) / counts[k]
        second = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                second[i, j] = second[j, i] = rows[k][f"p_{i}_{j}"] / counts[k]
        means.append(mean)
        scatters.append(second - np.outer(mean, mean))
    pooled = (counts[0] * scatters[0] + counts[1] * scatters[1]) / total
    whiten, constants = [], []
    for k in (0, 1):
        mixed = (1 - TO_POOLED) * scatters[k] + TO_POOLED * pooled
        mixed = (1 - TO_DIAGONAL) * mixed + TO_DIAGONAL * np.diag(np.diag(mixed)) + FLOOR * np.eye(size)
        factor = np.linalg.cholesky(mixed)
        whiten.append(np.linalg.inv(factor))
        constants.append(float(np.log(counts[k] / total) - np.log(np.diag(factor)).sum()))
    return Discriminant(means, whiten, constants, float(share))


def score(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """``(key, held_out, score, predicted)`` for each row of ``docs``."""
    measured = materialize(statistics(docs, text, key), "statistics")
    names = [c for c in measured.columns if c != key]
    taught = labels.select(key, F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col(key))
    )
    model = fit(measured.join(taught, key).select("label", *names))
    scored = measured.select(
        key,
        held_out(F.col(key)).alias("held_out"),
        model.score([F.col(c) for c in names]).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
