"""Severity of toxic text by cumulative-link ordinal regression over sparse text features.

Grades 0 to ``GRADES - 1``: P(grade <= k) = sigmoid(threshold k - weights . features), one weight for each feature shared by
all thresholds, which stay in order. A feature is a word (letters and digits, A to Z as a to z) or the first ``STEMS`` bytes of
a longer word, so that forms of a word count together. A feature has two values over the whole text, log(1 + count) and
log(1 + 100 count / (words + 20)), with a weight each: some words count however long the text, some only if dense. The output
is the expected severity, sum over k of P(grade > k); a document is toxic if P(grade > 0) reaches ``LEAST``.

The labels say toxic or not. A feature counts once in a document, in one of its contexts there (two words before and two
behind), and once in all documents in which that context is the same, so that neither long documents nor copies count often.
Features whose log odds in toxic and other documents differ by ``EVIDENCE`` standard errors are used, the ``FEATURES``
strongest at most. Grade 0 is not toxic; toxic documents are graded by thirds of their number of features that speak for
toxicity.

The model is fitted on a bounded sample: the ``SAMPLE`` labelled documents with the smallest hash of doc_id (all if fewer);
the driver holds their feature counts, never a text. Every document is scored, whole.

A null or empty text has no features. Rows that share a doc_id are scored one by one; if several labels share a doc_id, the
strongest counts; null labels count as not toxic. Without toxic or without other labels there is no model and every severity
is 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import SIGNS, Words, mix, pieces, word_hashes, words_of

GRADES = 4
SAMPLE = 10_000
FEATURES = 4096
EVIDENCE = 2.7
STEMS = (4, 5, 6, 7, 8)
LEAST = 0.5
_STEPS = 1000
_RIDGE = 3e-5


@dataclass
class Model:
    """features: sorted hashes; weights: of their counts, then of their densities; thresholds: GRADES - 1, ascending."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text and toxic (0 or 1) of the sample."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id"))
    marks = marks.agg((F.max(F.coalesce("toxic", F.lit(0))) > 0).cast("int").alias("toxic"))
    some = marks.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")


def _features(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words; word hashes; and the feature and word of every whole word and stem."""
    words = words_of(texts, SIGNS, fold=True)
    whole = word_hashes(words)
    features, at = [whole], [np.arange(len(whole))]
    for size in STEMS:
        longer = np.flatnonzero(words.ends - words.starts > size)
        stems = Words(words.raw, words.starts[longer], words.starts[longer] + size, words.first)
        features.append(mix(word_hashes(stems) + np.uint64(size)))
        at.append(longer)
    return words, whole, np.concatenate(features), np.concatenate(at)


def _evidence(sample: DataFrame, n_toxic: int, n_other: int, least: float, most: int) -> dict[int, float]:
    """Standard errors between the log odds of the chosen words in toxic and in other documents, by word hash."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words, whole, word, at = _features(batch.column("text"))
            if not len(whole):
                continue
            owner, beside = words.rows, np.zeros(len(whole), dtype=np.uint64)
            for step in (-2, -1, 1, 2):
                other = np.arange(len(whole)) + step
                near = (other >= 0) & (other < len(whole))
                near[near] = owner[other[near]] == owner[near]
                beside = mix(beside + np.where(near, whole[np.clip(other, 0, len(whole) - 1)], np.uint64(step + 3)))
            context, row = beside[at], owner[at]
            order = np.lexsort((context, word, row))
            word, context, row = word[order], context[order], row[order]
            first = np.ones(len(word), dtype=bool)
            first[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
            toxic = batch.column("toxic").to_numpy()[row[first]]
            columns = [pa.array(x[first].view(np.int64)) for x in (word, context)] + [pa.array(toxic)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "context", "toxic"])

    seen = sample.mapInArrow(contexts, "word long, context long, toxic int").distinct()
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / n_toxic) - F.log(b / n_other)
    z = odds / F.sqrt(1 / a + 1 / b)
    strong = counts.select("word", z.alias("z")).where(F.abs("z") >= least)
    return {r.word: r.z for r in strong.orderBy(F.abs("z").desc(), "word").limit(most).collect()}


def _counts(batch: pa.RecordBatch, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, column and value of all that a batch's texts have of the features: counts first, then densities."""
    words, _, found, at = _features(batch.column("text"))
    n = max(len(features), 1)
    place = np.minimum(np.searchsorted(features, found), n - 1)
    hit = features[place] == found if len(features) else np.zeros(len(found), bool)
    key, count = np.unique(words.rows[at[hit]] * n + place[hit], return_counts=True)
    row, column = key // n, key % n
    dense = np.log1p(100 * count / (np.diff(words.first)[row] + 20))
    order = np.argsort(np.concatenate((row, row)), kind="stable")
    return np.concatenate((row, row))[order], np.concatenate((column, column + n))[order], np.concatenate((np.log1p(count), dense))[order]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int, grades: int = GRADES):
    """Weights and thresholds by gradient ascent on the likelihood with a small ridge; the gaps between thresholds are
    exponentials, so they stay in order."""
    n = len(grade)
    shares = np.array([(np.sum(grade <= k) + 0.5) / (n + 1) for k in range(grades - 1)])
    first = np.log(shares / (1 - shares))
    params = np.concatenate((np.zeros(n_features), first[:1], np.log(np.maximum(np.diff(first), 0.1))))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, _STEPS + 1):
        weights, theta0, gaps = params[:n_features], params[n_features], np.exp(params[n_features + 1 :])
        theta = np.concatenate(([-np.inf], theta0 + np.concatenate(([0], np.cumsum(gaps))), [np.inf]))
        score = np.bincount(rows, weights=values * weights[columns], minlength=n)
        high, low = _sigmoid(theta[grade + 1] - score), _sigmoid(theta[grade] - score)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_score = d_low - d_high
        by_theta = np.array([d_high[grade == k].sum() - d_low[grade == k + 1].sum() for k in range(grades - 1)])
        later = np.cumsum(by_theta[::-1])[::-1]
        by_weight = np.bincount(columns, weights=values * d_score[rows], minlength=n_features)
        slope = np.concatenate(
            (by_weight / n - _RIDGE * weights, later[:1] / n, later[1:] * gaps / n)
        )
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        params = params + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    gaps = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.concatenate(([0], np.cumsum(gaps)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model; None without toxic or without other labels."""
    some = labelled(docs, labels, sample)
    sizes = {r.toxic: r.n for r in some.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    found = _evidence(some, sizes[1], sizes[0], EVIDENCE, FEATURES)
    order = np.argsort(np.array(list(found), dtype=np.int64).view(np.uint64))
    features = np.array(list(found), dtype=np.int64).view(np.uint64)[order]
    speaks = np.array(list(found.values()))[order] > 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            row, at, n = _counts(batch, features)
            split = np.searchsorted(row, np.arange(batch.num_rows + 1))
            columns = [[x[a:b] for a, b in zip(split[:-1], split[1:])] for x in (at, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(columns[0], pa.list_(pa.int64())), pa.array(columns[1], pa.list_(pa.float64()))],
                names=["toxic", "at", "n"],
            )

    data = some.mapInArrow(count, "toxic int, at array<long>, n array<double>").orderBy("toxic", "at", "n").toArrow()
    toxic = data["toxic"].to_numpy()
    at, n = (data[c].combine_chunks() for c in ("at", "n"))
    rows = np.repeat(np.arange(len(toxic)), at.value_lengths().to_numpy())
    at, n = at.flatten().to_numpy(), n.flatten().to_numpy()
    counted = at < len(features)
    hits = np.bincount(rows[counted], weights=np.expm1(n[counted]) * speaks[at[counted]], minlength=len(toxic)).round()
    thirds = np.quantile(hits[toxic > 0], [(k + 1) / (GRADES - 1) for k in range(GRADES - 2)])
    grade = np.where(toxic > 0, 1 + np.searchsorted(thirds, hits, side="left"), 0)
    weights, thresholds = fit(rows, at, n, grade, 2 * len(features))
    return Model(features, weights, thresholds)


def severity(docs: DataFrame, model: Model | None, least: float = LEAST) -> DataFrame:
    """doc_id, severity (expected grade), grade (most probable) and toxic of every document."""
    # Three small arrays with a proven bound: FEATURES hashes and weights.
    model = model or Model(np.zeros(0, np.uint64), np.zeros(0), None)
    features, weights, thresholds = model.features, model.weights, model.thresholds

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            above = np.zeros((batch.num_rows, GRADES - 1))
            if thresholds is not None:
                row, at, n = _counts(batch, features)
                total = np.bincount(row, weights=n * weights[at], minlength=batch.num_rows)
                above = 1 - _sigmoid(thresholds[None, :] - total[:, None])
            each = -np.diff(np.column_stack((np.ones(batch.num_rows), above, np.zeros(batch.num_rows))), axis=1)
            columns = [
                batch.column("doc_id"),
                pa.array(above.sum(axis=1)),
                pa.array(each.argmax(axis=1).astype(np.int32)),
                pa.array(above[:, 0] >= least),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "severity", "grade", "toxic"])

    kept = docs.select(F.col("doc_id").cast("long"), "text")
    return kept.mapInArrow(score, "doc_id long, severity double, grade int, toxic boolean")
