"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over quantile bins, and so have the strongest
pairs. Boosting goes round the features, each step adding a small part of a tree
of at most four leaves to one table; then round the pairs, with trees of four
quadrants. A score is a sum of table entries, so it can be read off term by term.
The fit takes a bounded sample of labelled rows; the features of every text come
from Spark expressions over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_sample, one_row
from corpusloom.llm.text_stats import FEATURES, with_features
from corpusloom.session import cut_lineage

SAMPLE_DOCUMENTS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
THRESHOLD = 0.5
_RIDGE = 1.0


def _gain(g, h):
    return g * g / (h + _RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins in two; 0 bins on the left: none helps."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return (float(gains[at]), at + 1) if gains[at] > 1e-9 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value per bin of a tree of two levels over the bins, by Newton steps on gradient and curvature sums."""
    edges = [0, len(g)]
    _, cut = _best_cut(g, h)
    if cut:
        edges = sorted({0, cut, len(g), _best_cut(g[:cut], h[:cut])[1], cut + _best_cut(g[cut:], h[cut:])[1]})
    values = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        values[a:b] = -g[a:b].sum() / (h[a:b].sum() + _RIDGE)
    return values


def quadrant_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best pair of cuts of a grid of sums into four quadrants."""
    best, values = 0.0, np.zeros_like(g)
    sums_g, sums_h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            corners = ((0, i, 0, j), (0, i, j, g.shape[1]), (i, g.shape[0], 0, j), (i, g.shape[0], j, g.shape[1]))
            parts = [
                tuple(s[b, d] - s[a, d] - s[b, c] + s[a, c] for s in (sums_g, sums_h)) for a, b, c, d in corners
            ]
            gain = sum(_gain(*part) for part in parts) - _gain(g.sum(), h.sum())
            if gain > best + 1e-9:
                best, values = gain, np.zeros_like(g)
                for (a, b, c, d), (pg, ph) in zip(corners, parts):
                    values[a:b, c:d] = -pg / (ph + _RIDGE)
    return best, values


@dataclass
class GamModel:
    """Bin edges and table of each feature, coarse edges and tables of pairs, intercept."""

    features: list[str]
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    intercept: float

    def probability(self, values: pd.DataFrame) -> np.ndarray:
        columns = [values.iloc[:, k].to_numpy(float) for k in range(len(self.features))]
        total = np.full(len(values), self.intercept)
        for column, edges, table in zip(columns, self.edges, self.tables):
            total += table[np.searchsorted(edges, column, side="right")]
        low = {k: np.searchsorted(self.coarse[k], columns[k], side="right") for pair in self.pairs for k in pair}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[low[a], low[b]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))

    def column(self) -> Column:
        """Score from the feature columns, by vectorised additions of table entries."""
        model = self

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(model.probability(batch))

        return score(F.struct(*self.features))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(column, np.arange(1, bins) / bins)) if len(column) else np.zeros(0)
    return cuts[cuts > column.min()] if len(column) else cuts


def fit_gam(values: pd.DataFrame, labels: np.ndarray) -> GamModel:
    """Fit to a bounded table of feature values; without rows of both kinds only the intercept is learned."""
    names, y = list(values.columns), np.asarray(labels, float)
    columns = [values[name].to_numpy(float) for name in names]
    share = np.clip((y.sum() + 0.5) / (len(y) + 1), 1e-3, 1 - 1e-3)
    edges, coarse = ([_edges(c, bins) for c in columns] for bins in (BINS, PAIR_BINS))
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = GamModel(names, edges, tables, coarse, [], [], float(np.log(share / (1 - share))))
    if y.min(initial=1) == y.max(initial=0):
        return model
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(edges, columns)]
    low = [np.searchsorted(e, c, side="right") for e, c in zip(coarse, columns)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for k, table in enumerate(tables):
            g, h = slopes()
            step = RATE * shallow_tree(*(np.bincount(bins[k], x, minlength=len(table)) for x in (g, h)))
            table += step
            total += step[bins[k]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        joint = low[a] * shape[1] + low[b]
        return tuple(np.bincount(joint, x, minlength=shape[0] * shape[1]).reshape(shape) for x in slopes())

    gains = sorted(((-quadrant_tree(*grid(a, b))[0], a, b) for a, b in combinations(range(len(names)), 2)))
    model.pairs = [(a, b) for gain, a, b in gains[:PAIRS] if gain < -1e-6]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = RATE * quadrant_tree(*grid(a, b))[1]
            table += step
            total += step[low[a], low[b]]
    return model


def learn_quality(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> GamModel:
    """A model from feature rows and (doc_id, label), about ``sample`` labelled ids being looked at, one row of each."""
    # Bounded by the parameter, so it may be broadcast and its rows collected.
    known = one_row(measured.join(F.broadcast(bounded_sample(labels, sample)), "doc_id"), "label", *FEATURES).toPandas()
    known = known.sort_values(list(known.columns), kind="stable")
    return fit_gam(known[FEATURES], known["label"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, threshold: float = THRESHOLD):
    """(doc_id, score, predicted), one row per row of (doc_id, text), and the model learned from (doc_id, label).

    Missing texts count as empty; missing ids and repeated rows are scored each; other
    columns are ignored; an empty table gives no rows, and no labels a score of about a half.
    """
    measured = cut_lineage(with_features(docs))
    model = learn_quality(measured, labels, sample)
    scored = measured.select("doc_id", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")), model
