"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Counts of n-grams per class come from Spark; a ratio r is the log of an n-gram's
share among toxic documents over its share among the others. A document is the
set of its n-grams, each with the value r, and logistic regression weighs them.
The fit looks at a bounded sample of labelled documents; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.slices import by_slices
from corpusloom.llm.common import bounded_sample, one_row, slices, whole_text, worker_state

SIZES = (4, 5, 6)
BUCKET_BITS = 20
SAMPLE_DOCUMENTS = 16_000
FEATURES = 4_096
THRESHOLD = 0.3
_FIT_ROWS = 1_000


def gram_buckets(text: str | None) -> np.ndarray:
    """Hash buckets of the n-grams (code points, lower case, white space as one blank) of a whole text, repeated ones too."""
    plain = " " + " ".join((text or "").lower().split()) + " "
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found, rolling = [], points + np.uint32(0x9E3779B9)
    for size in range(2, max(SIZES) + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) + points[size - 1 :]
        if not len(rolling):
            break
        if size in SIZES:
            mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)
            found.append(mixed >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


@dataclass
class ToxicityModel:
    """Weight of each n-gram bucket that counts (ratio times learned weight), and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        table = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
        table[self.buckets] = self.weights
        return table

    def column(self, text: Column | str) -> Column:
        """Probability that the text is toxic; a missing or empty text has the one of no n-grams."""
        model = self

        def start():
            worker_state("toxicity", object)  # words that other operators keep go
            table = model.table()
            return lambda text: model.probability(text, table)

        return by_slices(T.DoubleType(), pa.float64(), start)(whole_text(text))

    def probability(self, text: str | None, table: np.ndarray) -> float:
        buckets = gram_buckets(text)
        buckets = np.unique(buckets[table[buckets] != 0])
        value = self.intercept + float(table[buckets].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(value, -40, 40))))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class with each n-gram, summed over the task."""
    worker_state("toxicity", object)
    counts = np.zeros((2, 1 << BUCKET_BITS), dtype=np.int32)
    for batch in slices(batches):
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[label, np.unique(gram_buckets(text))] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(seen), 100_000):
        part = seen[at : at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(counts[1, part]), pa.array(counts[0, part])], ["bucket", "toxic", "clean"]
        )


def _chosen_grams(chosen: np.ndarray):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
        place[chosen] = np.arange(len(chosen))
        for batch in slices(batches):
            rows = [place[np.unique(gram_buckets(text))] for text in batch.column(1).to_pylist()]
            rows = [row[row >= 0] for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "grams"])

    return keep


def fit_logistic(rows: list[np.ndarray], values: np.ndarray, labels: np.ndarray, penalty: float = 3e-4, steps: int = 150):
    """Weights and intercept for documents given as arrays of feature numbers, feature j having ``values[j]``."""
    parts = [rows[at : at + _FIT_ROWS] for at in range(0, len(rows), _FIT_ROWS)]
    sizes = [np.array([len(r) for r in part]) for part in parts]
    parts = [np.concatenate(part).astype(np.int32) for part in parts]
    targets = [labels[at : at + _FIT_ROWS] for at in range(0, len(rows), _FIT_ROWS)]
    n, share = max(1, len(rows)), np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    theta = np.append(np.zeros(len(values)), np.log(share / (1 - share)))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        gradient = np.append(penalty * theta[:-1], 0.0)
        scaled = values * theta[:-1]
        for columns, size, target in zip(parts, sizes, targets):
            owner = np.repeat(np.arange(len(size)), size)
            margin = np.bincount(owner, scaled[columns], minlength=len(size)) + theta[-1]
            error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target) / n
            gradient[:-1] += values * np.bincount(columns, error[owner], minlength=len(values))
            gradient[-1] += error.sum()
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        rate = 0.05 * (0.1 if step > steps * 0.8 else 1.0)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, features: int = FEATURES, at_least: int = 3
) -> ToxicityModel:
    """A model from (doc_id, text) and (doc_id, label): about ``sample`` labelled ids, those whose hash is lowest.

    Of several rows of an id the one with the least text teaches.

    N-grams in fewer than ``at_least`` of them do not count; of the rest the
    ``features`` with the largest chi-square do. Without labels of both kinds the
    model gives every text the share of toxic labels, a half if there are none.
    """
    # Bounded by the parameter, so it may be broadcast.
    chosen_ids = F.broadcast(bounded_sample(labels, sample))
    texts = docs.select("doc_id", whole_text("text").alias("text")).join(chosen_ids, "doc_id")
    texts = one_row(texts, "label", "text")
    sizes = labels_in(texts)
    total = sizes[0] + sizes[1]
    sums = texts.mapInArrow(_count_grams, "bucket int, toxic int, clean int").groupBy("bucket")
    sums = sums.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = F.col("toxic") + F.col("clean")
    expected = seen * F.lit(sizes[1] / max(1, total))
    spread = expected * (1 - seen / F.lit(max(1, total))) * F.lit(sizes[0] / max(1, total)) + 1e-9
    ranked = sums.where(seen >= at_least).orderBy(F.desc(F.pow(F.col("toxic") - expected, 2) / spread), "bucket")
    # The driver sees the best buckets only, at most ``features`` rows.
    best = ranked.limit(features).toPandas() if sizes[0] and sizes[1] else None
    if best is None or best.empty:
        share = (sizes[1] + 1) / (total + 2)
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    toxic, clean, buckets = best["toxic"].to_numpy(float) + 1, best["clean"].to_numpy(float) + 1, best["bucket"].to_numpy()
    ratios = np.log((toxic / toxic.sum()) / (clean / clean.sum()))
    kept = texts.mapInArrow(_chosen_grams(buckets), "label int, grams array<int>").toArrow()
    grams = [one.values.to_numpy() for one in kept["grams"]]
    weights, intercept = fit_logistic(grams, ratios, kept["label"].to_numpy().astype(float))
    return ToxicityModel(buckets, weights * ratios, intercept)


def labels_in(texts: DataFrame) -> tuple[int, int]:
    found = {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    return found.get(0, 0), found.get(1, 0)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted), one row per row of (doc_id, text).

    Missing texts score as empty ones; missing ids and repeated rows are scored each;
    other columns are ignored; an empty table gives no rows.
    """
    scored = docs.select("doc_id", model.column("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
