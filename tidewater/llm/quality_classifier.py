"""Quality classifier: a generalised additive model with pairwise interactions.

The model is a sum of lookup tables: one per feature over its bins, and one per chosen pair of
features over coarser bins. They are learned by boosting in cycles: each table in turn gets a
small step from a shallow tree fitted to the present residuals. A score is an addition of table
entries, for whole batches at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import free_names, in_small_batches, raw_text
from tidewater.llm.quality_rules import _CAPITALS, _MARKS, repeated_words

FEATURES = (
    "log_words",
    "word_length",
    "symbols",
    "dup_lines",
    "repeats",
    "capitals",
    "marks",
    "digits",
    "beyond_ascii",
    "distinct_words",
    "doubled_words",
    "line_words",
    "longest_word",
)
TRAINING_ROWS = 20_000  # labelled documents that the model is fitted on at most
BINS, PAIR_BINS = 32, 8
CYCLES, PAIR_CYCLES, PAIRS = 150, 60, 6
RATE, LEAVES, RIDGE = 0.15, 3, 5.0
THRESHOLD = 0.3

_DIGITS = b"0123456789"
_SIGNS = b"#*$%&|<>"


def features_of(raw: bytes) -> tuple[float, ...]:
    """Statistics of a whole text; all finite, zero for an empty one."""
    words = raw.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]

    def share(signs: bytes) -> float:
        return (len(raw) - len(raw.translate(None, signs))) / size

    doubled = sum(a == b for a, b in zip(words, words[1:]))
    beyond = int(np.count_nonzero(np.frombuffer(raw, np.uint8) >= 128))
    return (
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        share(_SIGNS) * size / n,
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        repeated_words(words) / n,
        share(_CAPITALS),
        share(_MARKS),
        share(_DIGITS),
        beyond / size,
        len(set(words)) / n,
        doubled / n,
        np.log1p(len(words) / max(len(lines), 1)),
        np.log1p(max(map(len, words), default=0)),
    )


def feature_frame(batch: pd.Series) -> np.ndarray:
    return np.array([features_of(raw) for raw in batch], np.float64).reshape(-1, len(FEATURES))


@dataclass
class AdditiveModel:
    """Cut points and tables; a feature's bin is the number of its cuts at or below the value."""

    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0

    def bins(self, x: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(cuts)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for table, at in zip(self.tables, self.bins(x, self.cuts)):
            out += table[at]
        coarse = self.bins(x, self.pair_cuts) if self.pairs else []
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[coarse[i], coarse[j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Distinct quantiles; a value on a cut lies in the bin above it."""
    cuts = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
    return cuts[cuts > values.min()] if len(values) else cuts


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree_steps(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Steps per bin of a tree of at most ``LEAVES`` leaves over ordered bins."""
    edges = [0, len(g)]
    for _ in range(LEAVES - 1):
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:]):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            k = int(np.argmax(gains))
            best = max(best, (float(gains[k]), a + k + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    steps = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        steps[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return steps


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features once: its gain and its steps per cell."""
    cum_g, cum_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if g.shape[0] < 2 or g.shape[1] < 2:
        return 0.0, np.zeros(g.shape)
    all_g, all_h = cum_g[-1, -1], cum_h[-1, -1]

    def four(c, total):
        low, top, left = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return low, top - low, left - low, total - top - left + low

    gains = sum(_gain(x, y) for x, y in zip(four(cum_g, all_g), four(cum_h, all_h)))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    steps = np.zeros(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            steps[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + RIDGE)
    return float(gains[i, j] - _gain(all_g, all_h)), steps


def fit_model(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit on a feature matrix and 0/1 labels.

    The start is the smoothed log odds of the labels, so that with no rows every score is 0.5,
    and with one class all scores are near it.
    """
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not len(y):
        return AdditiveModel([], [], start=start)
    model = AdditiveModel([_cut_points(c, BINS) for c in x.T], [], start=start)
    at = model.bins(x, model.cuts)
    sizes = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(n) for n in sizes]
    logits = np.full(len(y), start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(CYCLES):
        for table, place, n in zip(model.tables, at, sizes):
            g, h = slopes()
            steps = RATE * _tree_steps(np.bincount(place, g, n), np.bincount(place, h, n))
            table += steps
            logits += steps[place]

    # Pairs: those whose best two-way cut explains most of what the single tables leave.
    model.pair_cuts = [_cut_points(c, PAIR_BINS) for c in x.T]
    coarse = model.bins(x, model.pair_cuts)
    shapes = [len(c) + 1 for c in model.pair_cuts]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        cell, shape = coarse[i] * shapes[j] + coarse[j], (shapes[i], shapes[j])
        size = shapes[i] * shapes[j]
        return tuple(np.bincount(cell, v, size).reshape(shape) for v in slopes())

    ranked = sorted(
        ((_quadrants(*grids(i, j))[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True
    )
    model.pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((shapes[i], shapes[j])) for i, j in model.pairs]
    for _ in range(PAIR_CYCLES):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            steps = RATE * _quadrants(*grids(i, j))[1]
            table += steps
            logits += steps[coarse[i], coarse[j]]
    return model


def training_matrix(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAINING_ROWS,
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled documents, those of least id hash.

    ``labels`` holds one 0/1 label per id; of several for an id the largest counts, and missing
    ids and labels do not. Only the sampled ids, a bounded number, are sent to all tasks.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.dropna().groupBy("id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    labelled = in_small_batches(docs).select(F.col(id_col).alias("id"), raw_text(text_col).alias("raw")).join(
        F.broadcast(sample), "id"
    )

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(feature_frame(batch)), dtype=object)

    # Rows that repeat an id would take the sample beyond its bound: one text per id.
    found = labelled.groupBy("id", "label").agg(F.min("raw").alias("raw"))
    got = found.select("id", "label", vectors("raw").alias("x")).orderBy("id").toPandas()
    x = np.array(got["x"].to_list(), np.float64).reshape(-1, len(FEATURES))
    return x, got["label"].to_numpy(np.float64)


def score_of(model: AdditiveModel, text_col: str = "text") -> Column:
    """The model's score of a whole text, 0 to 1; the model is a few thousand numbers."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(feature_frame(batch)))

    return score(raw_text(text_col))


def classify(docs: DataFrame, model: AdditiveModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is at least 0.3).

    Null texts score like empty ones. Output names replace input columns, all others are kept;
    repeated rows come out as often; an empty table gives an empty table.
    """
    (s,) = free_names(docs, "_score")
    scored = in_small_batches(docs).withColumn(s, score_of(model, text_col))
    predicted = F.when(F.col(s) >= THRESHOLD, 1).otherwise(0)
    return scored.withColumns({"score": F.col(s), "predicted": predicted}).drop(s)


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fold of ids that no model may learn from; a missing id is in it."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 5 == 0
