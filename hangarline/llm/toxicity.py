"""Toxicity by maximum-scoring segments.

Words are weighted by their log-odds between toxic and clean labelled texts under a Dirichlet prior; words whose odds are
not significant weigh nothing, and every word pays a small toll, so that ordinary text drifts down. A linear scan finds
all maximal segments of a text (runs of words whose weights add up most). Under Karlin-Altschul statistics the best
segment of an ordinary text of n words exceeds S with an expected count of K n exp(-lambda S); segments with a small
expectation are passages. The probability that a document is toxic is a logistic function of the best segment's
excess and the number of passages, fitted on the learning rows.

Scale: weights are learned from a bounded sample of labelled rows (`max_rows`, those with the smallest hash of their
doc_id), so the weights have a size bound and are sent to the tasks; scoring is one pass over the scan, without a shuffle.

Null text counts as empty: no words, the lowest score. A null doc_id is not held out and never learned from. Labels
that contradict each other, or are null, teach nothing. Without labels of both kinds every score is zero. Repeated
rows are scored one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 20_000
HELD_OUT_OF, HELD_OUT_IS = 4, 2
THRESHOLD = 0.3
#: Pseudo-occurrences of each word, shared by the classes as their texts are.
PRIOR = 0.5
SIGNIFICANCE = 3.0
TOLL = 0.2
#: Expected number of such segments in an ordinary text, below which a segment is a passage.
EXPECTED = 0.05

WORD = re.compile(r"[^\W_]+")


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(remainder == HELD_OUT_IS, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text, toxic of at most max_rows labelled documents that are not held out, whose ids are broadcast.

    Equal texts count once, and not at all if their labels differ.
    """
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
    labels = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    agreed = labels.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high"))
    agreed = agreed.where("toxic = high").select("doc_id", "toxic")
    sample = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = rows.join(F.broadcast(sample), "doc_id").groupBy("text")
    return texts.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).where("toxic = high").drop("high")


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if toxic in counts:
                counts[toxic].update(set(WORD.findall((text or "").lower())))
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(words, pa.string()),
                "toxic": pa.array([counts[1][w] for w in words], pa.int64()),
                "clean": pa.array([counts[0][w] for w in words], pa.int64()),
            }
        )


def word_weights(rows: DataFrame) -> DataFrame:
    """word, toxic, clean, log_odds, z: informative-prior log-odds of each word; a text counts a word once."""
    counts = rows.select("text", "toxic").mapInArrow(_count_batches, "word string, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    toxic, clean = float(totals.toxic or 0), float(totals.clean or 0)
    if not toxic or not clean:
        return counts.select("word", "toxic", "clean", F.lit(0.0).alias("log_odds"), F.lit(0.0).alias("z")).where("false")
    a = F.col("toxic") + PRIOR * toxic / (toxic + clean)
    b = F.col("clean") + PRIOR * clean / (toxic + clean)
    log_odds = F.log(a / b) - math.log(toxic / clean)
    return counts.withColumn("log_odds", log_odds).withColumn("z", F.col("log_odds") / F.sqrt(1 / a + 1 / b))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end) with their scores, in linear time, by Ruzzo and Tompa's stack.

    Only positions with positive scores open segments; what lies between them enters through the running totals.
    """
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []  # start, end, total before start, total at end, index of the entry it must look at next
    for at in np.flatnonzero(scores > 0).tolist():
        start, low, high = at, float(totals[at]), float(totals[at + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append([start, at + 1, low, high, j])
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(start, end, high - low) for start, end, low, high, _ in stack]


def _lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(weights * exp(x * scores)) = 1: how fast the chance of a score falls off."""
    if scores.max() <= 0 or (scores * weights).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (weights * np.exp(np.minimum(high * scores, 600))).sum() < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (weights * np.exp(np.minimum(middle * scores, 600))).sum() < 1 else (low, middle)
    return high


class SegmentModel:
    """Weights of words, the statistics of ordinary texts, and the logistic calibration."""

    def __init__(self, weights: dict[str, float], rate: float):
        self.weights, self.rate = weights, rate
        self.log_k, self.slopes = 0.0, np.array([-20.0, 0.0, 0.0])

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = WORD.findall((text or "").lower())
        get = self.weights.get
        scores = np.fromiter((get(w, 0.0) for w in words), dtype=np.float64, count=len(words)) - TOLL
        return len(words), maximal_segments(scores)

    def features(self, words: int, segments: list[tuple[int, int, float]]) -> tuple[float, float]:
        """The best segment's excess over an ordinary text's, and how many segments are passages."""
        if not segments:
            return -10.0, 0.0
        excess = [self.rate * score - self.log_k - math.log(words) for _, _, score in segments]
        return max(-10.0, max(excess)), float(sum(x > -math.log(EXPECTED) for x in excess))

    def probability(self, features: np.ndarray) -> np.ndarray:
        x = self.slopes[0] + _shaped(features) @ self.slopes[1:]
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _shaped(features: np.ndarray) -> np.ndarray:
    """Excess up to a limit and the logarithm of the number of passages, so that single texts do not rule the fit."""
    return np.column_stack([np.clip(features[:, 0], -10, 20), np.log1p(features[:, 1])])


def _logistic(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Intercept and slopes by Newton steps, with a weak pull to zero that keeps separable data finite."""
    x = np.column_stack([np.ones(len(features)), _shaped(features)])
    slopes, pull = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ slopes, -40, 40)))
        gradient = x.T @ (p - toxic) + pull * slopes
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pull), gradient)
        slopes = slopes - step
        if np.abs(step).max() < 1e-9:
            break
    return slopes


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> SegmentModel | None:
    """The model, from at most max_rows rows; None without both kinds. What reaches the driver is bounded by max_rows."""
    rows = learning_rows(docs, labels, max_rows)
    counted = word_weights(rows)
    kept = counted.where(F.abs("z") >= SIGNIFICANCE).select("word", "log_odds", "clean").collect()
    clean_words = counted.agg(F.sum("clean").alias("n")).first()["n"]
    if not clean_words or not any(row.log_odds > 0 for row in kept):
        return None
    weights = {row.word: row.log_odds for row in kept}
    scores = np.array([row.log_odds - TOLL for row in kept] + [-TOLL])
    shares = np.array([row.clean + PRIOR for row in kept], dtype=np.float64) / clean_words
    model = SegmentModel(weights, _lambda(scores, np.append(shares, max(0.0, 1 - shares.sum()))))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.segments(text) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column(1).cast(pa.int64()),
                    "words": pa.array([n for n, _ in found], pa.int64()),
                    "scores": pa.array([[s for _, _, s in segments] for _, segments in found], pa.list_(pa.float64())),
                }
            )

    seen = rows.select("text", "toxic").mapInArrow(best, "toxic long, words long, scores array<double>").collect()
    ordinary = [model.rate * max(r.scores) - math.log(r.words) for r in seen if r.toxic == 0 and r.scores]
    model.log_k = float(np.mean(ordinary) - 0.5772156649) if ordinary else 0.0
    features = np.array([model.features(r.words, [(0, 0, s) for s in r.scores]) for r in seen])
    model.slopes = _logistic(features, np.array([r.toxic for r in seen], dtype=np.float64))
    return model


PASSAGE = pa.struct([("first", pa.int64()), ("after", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])
SCHEMA = (
    "doc_id long, score double, n_passages long, "
    "passages array<struct<first: long, after: long, score: double, expected: double>>"
)


def _score_batches(model: SegmentModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, passages = np.empty((batch.num_rows, 2)), []
            for i, text in enumerate(batch.column(1)):
                words, segments = model.segments(text.as_py()) if model else (0, [])
                features[i] = model.features(words, segments) if model else (0, 0)
                expected = [math.exp(min(700.0, model.log_k + math.log(words) - model.rate * s)) for _, _, s in segments]
                passages.append(
                    [
                        {"first": a, "after": b, "score": s, "expected": e}
                        for (a, b, s), e in zip(segments, expected, strict=True)
                        if e < EXPECTED
                    ]
                )
            score = model.probability(features) if model else np.zeros(batch.num_rows)
            columns = {"doc_id": batch.column(0), "score": pa.array(score, pa.float64())}
            columns["n_passages"] = pa.array([len(x) for x in passages], pa.int64())
            columns["passages"] = pa.array(passages, pa.list_(PASSAGE))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, and the passages [first, after) of words with their statistics."""
    model = learn(docs, labels, max_rows)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = rows.mapInArrow(_score_batches(model), SCHEMA)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_passages",
        "passages",
    )
