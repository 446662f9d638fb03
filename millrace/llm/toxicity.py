"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Grades run from 0 (not toxic) upwards. The labels only say toxic or not, so the grades are made:
toxic rows of the fit are graded 1 to 3 by terciles of how many different insults they hold.
Insults are whole words strongly tied to the label in the other half of the fitted rows, so that no
row is graded by a list that it taught. Severity is as good as that rule; nothing else says how
toxic a text is. Insults are counted, not set against the length: features say what a text holds and
not how long it is, so grades by density would pull the shared weights against the label. One weight
per word or beginning of a word is shared by all ordered thresholds: P(grade <= k) = logistic(threshold_k - sum of
weights of the text's distinct features). Outputs are the probability of each side, the
expected grade (severity), and whether the text is toxic, which is when a grade of 1 or more
is at least as likely as 0.

The model is fitted on at most FIT_ROWS labelled rows outside the held-out fold, chosen by a
hash of their key; its features are the VOCABULARY ones that tell the classes apart best.
Null and empty texts hold no features and get the score of the thresholds alone. Without both
classes among the labels nothing is toxic. Texts are read whole. Rows keep their number, and
``keep_clean`` returns the table's own columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import held_out, map_batches
from millrace.workspace import materialize

FIT_ROWS = 20_000
VOCABULARY = 2_048
GRADES = 3
#: Features in fewer fitted rows are not used.
LEAST_ROWS = 3
#: Deviations from which a word counts as an insult for grading.
STRONG = 4.0
L2, RATE, ROUNDS = 2e-5, 0.1, 300

#: Texts whose features a worker holds at once.
SLICE_ROWS = 32
#: Lengths of the beginnings of words that are features.
BEGINNINGS = (5, 6, 7, 8)
WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> set[str]:
    """Distinct runs of letters, lower-cased, and beginnings of them, marked ``^``.

    Beginnings let inflected and compounded words stand for each other.
    """
    words = set(WORD.findall((text or "").lower()))
    found = set(words)
    for size in BEGINNINGS:
        found.update(["^" + word[:size] for word in words if len(word) >= size])
    return found


def few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches, since the features of a text take many times its size in Python."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(first, SLICE_ROWS)


@dataclass
class OrdinalModel:
    """Weights by word and increasing thresholds; no thresholds: nothing is toxic."""

    weights: dict[str, float]
    thresholds: list[float]

    def judge(self, text: str | None) -> tuple[float, float, bool]:
        """Probability of a grade above 0, expected grade, toxic."""
        if not self.thresholds:
            return 0.0, 0.0, False
        weights = self.weights
        total = sum(sorted(weights[w] for w in features_of(text) & weights.keys()))
        above = [float(1 / (1 + np.exp(min(500.0, t - total)))) for t in self.thresholds]
        return above[0], sum(above), above[0] >= 0.5


def fit_thresholds(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised loss. ``rows`` and ``columns`` list the ones
    of the 0/1 matrix; grades run from 0 without a gap."""
    levels = int(grades.max())
    weights, gaps = np.zeros(size), np.zeros(levels)
    gaps[0] = 1.0
    moments = [np.zeros(size + levels), np.zeros(size + levels)]
    count = len(grades)
    for step in range(1, ROUNDS + 1):
        cuts = np.concatenate([[gaps[0]], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
        total = np.bincount(rows, weights[columns], count)
        below = 1 / (1 + np.exp(np.clip(total[:, None] - cuts, -500, 500)))
        full = np.concatenate([np.zeros((count, 1)), below, np.ones((count, 1))], axis=1)
        slope = np.concatenate([np.zeros((count, 1)), below * (1 - below), np.zeros((count, 1))], axis=1)
        at = np.arange(count)
        chance = np.maximum(full[at, grades + 1] - full[at, grades], 1e-12)
        upper, lower = slope[at, grades + 1] / chance, slope[at, grades] / chance
        to_cut = np.zeros(levels)
        for k in range(levels):
            to_cut[k] = (lower[grades == k + 1].sum() - upper[grades == k].sum()) / count
        to_gap = np.concatenate([[to_cut.sum()], np.exp(gaps[1:]) * np.cumsum(to_cut[::-1])[::-1][1:]])
        to_weight = np.bincount(columns, ((upper - lower) / count)[rows], size) + L2 * weights
        gradient = np.concatenate([to_weight, to_gap])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights -= move[:size]
        gaps -= move[size:]
    return weights, np.concatenate([[gaps[0]], gaps[0] + np.cumsum(np.exp(gaps[1:]))])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> OrdinalModel:
    """Learn from at most FIT_ROWS labelled rows; that many short lists reach the driver."""
    taught = (
        labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
        .where(F.col("__label").isin(0, 1) & ~held_out(F.col("__key")))
        .groupBy("__key").agg(F.max("__label").alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key").limit(FIT_ROWS)
    )
    known = (
        docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
        .join(F.broadcast(taught), "__key")  # FIT_ROWS rows of two numbers at most
        .groupBy("__key", "__label").agg(F.min("__text").alias("__text"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            texts = batch.column(2).to_pylist()
            words = pa.array([sorted(features_of(x)) for x in texts], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], words], ["label", "half", "words"])

    half = (F.crc32(F.col("__key").cast("string")).bitwiseAND(F.lit(1 << 8)) > 0).cast("int")
    listed = materialize(
        map_batches(known.select("__label", half.alias("half"), "__text"), split, "label int, half int, words array<string>"),
        "words",
    )
    sizes = {r["label"]: r["count"] for r in listed.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return OrdinalModel({}, [])
    def tied(rows: DataFrame) -> DataFrame:
        """``word`` and ``z``: by how many deviations a feature is more common in toxic rows."""
        known = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        share = known.get(1, 0) / max(1, sum(known.values()))
        seen = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(
            F.count("*").alias("rows"), F.sum("label").alias("toxic")
        )
        spread = F.sqrt(F.col("rows") * share * (1 - share))
        z = F.when(spread > 0, (F.col("toxic") - F.col("rows") * share) / spread).otherwise(0.0)
        return seen.where(F.col("rows") >= LEAST_ROWS).withColumn("z", z)

    top = tied(listed).orderBy(F.abs("z").desc(), "word").limit(VOCABULARY).select("word", "z").collect()
    index = {r["word"]: i for i, r in enumerate(top)}
    insults = [
        {
            r["word"]
            for r in tied(listed.where(F.col("half") == number)).where((F.col("z") >= STRONG) & ~F.startswith("word", F.lit("^")))
            .orderBy(F.desc("z"), "word").limit(VOCABULARY).collect()
        }
        for number in (0, 1)
    ]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            words = batch.column(2).to_pylist()
            hits = pa.array([[index[w] for w in row if w in index] for row in words], pa.list_(pa.int32()))
            halves = batch.column(1).to_pylist()
            found = pa.array([sum(w in insults[1 - half] for w in row) for row, half in zip(words, halves)], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), hits, found], ["label", "hits", "evidence"])

    found = map_batches(listed, find, "label int, hits array<int>, evidence int").toArrow()
    toxic, evidence = found["label"].to_numpy(), found["evidence"].to_numpy()
    hits = found["hits"].combine_chunks()
    columns = hits.flatten().to_numpy()
    rows = np.repeat(np.arange(len(toxic)), hits.value_lengths().to_numpy())
    cuts = np.quantile(evidence[toxic == 1], [i / GRADES for i in range(1, GRADES)])
    grades = np.where(toxic == 1, 1 + (evidence[:, None] > cuts).sum(axis=1), 0)
    grades = np.unique(grades, return_inverse=True)[1]
    weights, thresholds = fit_thresholds(rows, columns, grades, len(top))
    return OrdinalModel({r["word"]: float(w) for r, w in zip(top, weights)}, [float(t) for t in thresholds])


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, p_toxic, severity, toxic)`` for each row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [model.judge(x.as_py()) for x in batch.column(1)]
            columns = [pa.array([j[i] for j in judged], t) for i, t in enumerate((pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, "p_toxic", "severity", "toxic"])

    picked = docs.select(key, F.col(text).cast("string").alias("__text"))
    return map_batches(picked, run, f"`{key}` {kind}, p_toxic double, severity double, toxic boolean")


def keep_clean(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [not model.judge(x.as_py())[2] for x in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_batches(docs, run, docs.schema)
