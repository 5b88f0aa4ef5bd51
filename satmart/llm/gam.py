"""Quality classifier: a generalised additive model with pairwise interactions. Shallow trees are
boosted on one feature, or one pair, at a time in a cycle; what they add up to is a lookup table
per feature and per pair, so a text is scored by adding one table entry for each."""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from satmart.llm import common, quality_rules

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!?"
_LINE_STOPS = b".!?:;"
FEATURES = [
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "commonest",
    "upper", "digits", "marks", "line_words", "short_words", "stops",
]


@dataclass(frozen=True)
class Fit:
    """How a model is fitted. ``rows`` bounds the labelled texts that are brought to the driver."""

    rows: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 150
    rate: float = 0.15
    ridge: float = 1.0


@dataclass(frozen=True)
class Model:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]


def features_of(raw: bytes) -> tuple[float, ...]:
    """Numbers that describe one whole text; the empty text has zeros throughout."""
    n_words, chars, symbols, n_lines, dup_lines, repeats = quality_rules.measures_of(raw)
    if not n_words:
        return (0.0,) * len(FEATURES)
    words = raw.split()
    counts = Counter(words)

    def share(wanted: bytes) -> float:
        return (len(raw) - len(raw.translate(None, wanted))) / chars

    return (
        float(np.log1p(n_words)), chars / n_words, symbols / n_words, dup_lines / n_lines,
        repeats / n_words, len(counts) / n_words, max(counts.values()) / n_words,
        share(_UPPER), share(_DIGITS), share(_MARKS), n_words / n_lines,
        sum(c for w, c in counts.items() if len(w) < 3) / n_words,
        share(_LINE_STOPS),
    )


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> int:
    """Where to cut a row of bins in two; 0 if nothing is gained."""
    if g.size < 2:
        return 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge)
    at = int(np.argmax(gain))
    return at + 1 if gain[at] > all_g**2 / (all_h + ridge) + 1e-12 else 0


def _tree(g: np.ndarray, h: np.ndarray, ridge: float, depth: int = 2) -> np.ndarray:
    """Step per bin of a shallow tree over ordered bins."""
    cut = _best_cut(g, h, ridge) if depth else 0
    if not cut:
        return np.full(g.size, g.sum() / (h.sum() + ridge))
    return np.concatenate([_tree(g[:cut], h[:cut], ridge, depth - 1),
                           _tree(g[cut:], h[cut:], ridge, depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree that cuts both axes of a pair's bins once."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def corners(c):
        top = c[:-1, -1:] - c[:-1, :-1]
        low = c[-1:, :-1] - c[:-1, :-1]
        return c[:-1, :-1], top, low, c[-1, -1] - c[:-1, :-1] - top - low

    parts = list(zip(corners(cg), corners(ch)))
    gain = sum(a**2 / (b + ridge) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [a[i, j] / (b[i, j] + ridge) for a, b in parts]
    step = np.empty(g.shape)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :] = values[0], values[1]
    step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = values[2], values[3]
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + ridge)), step


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, how: Fit = Fit()) -> Model:
    """Fits tables to features and labels; with no rows, or one class, only the intercept counts."""
    share = (y.sum() + 1) / (y.size + 2)
    model = Model(float(np.log(share / (1 - share))), [], [], [], [], [])
    if not y.size or y.min() == y.max():
        return model
    n = x.shape[1]
    edges = [_edges(x[:, f], how.bins) for f in range(n)]
    bins = [np.searchsorted(edges[f], x[:, f], "right") for f in range(n)]
    tables = [np.zeros(e.size + 1) for e in edges]
    logit = np.full(y.size, model.intercept)

    def slopes():
        p = _sigmoid(logit)
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for f in range(n):
            g, h = (np.bincount(bins[f], v, tables[f].size) for v in slopes())
            step = how.rate * _tree(g, h, how.ridge)
            tables[f] += step
            logit += step[bins[f]]

    pair_edges = [_edges(x[:, f], how.pair_bins) for f in range(n)]
    coarse = [np.searchsorted(pair_edges[f], x[:, f], "right") for f in range(n)]

    def squares(a, b):
        shape = pair_edges[a].size + 1, pair_edges[b].size + 1
        cell = coarse[a] * shape[1] + coarse[b]
        return cell, [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in slopes()]

    usable = [p for p in combinations(range(n), 2) if all(pair_edges[f].size for f in p)]
    gains = sorted(((-_quadrants(*squares(*p)[1], how.ridge)[0], p) for p in usable))
    pairs = [p for _, p in gains[: how.pairs]]
    pair_tables = [np.zeros((pair_edges[a].size + 1, pair_edges[b].size + 1)) for a, b in pairs]
    for _ in range(how.rounds):
        for k, pair in enumerate(pairs):
            cell, (g, h) = squares(*pair)
            step = how.rate * _quadrants(g, h, how.ridge)[1]
            pair_tables[k] += step
            logit += step.ravel()[cell]
    return Model(model.intercept, edges, tables, pairs, pair_edges, pair_tables)


def score(model: Model, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row of features."""
    logit = np.full(len(x), model.intercept)
    for f, (edges, table) in enumerate(zip(model.edges, model.tables)):
        logit += table[np.searchsorted(edges, x[:, f], "right")]
    for (a, b), table in zip(model.pairs, model.pair_tables):
        at = [np.searchsorted(model.pair_edges[f], x[:, f], "right") for f in (a, b)]
        logit += table[at[0], at[1]]
    return _sigmoid(logit)


def train(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> Model:
    """Fits on the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label) names.

    The bound on labelled rows takes those with the smallest hashes of their ids, whatever the
    size of the tables. Only features and labels come to the driver. Repeated labels and texts count
    each time, contradicting ones both; null labels and ids are left out; without labels, or with
    one of them only, every text has the same score. Other columns are not read.
    """
    chosen = (
        labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .select("doc_id", F.col("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(how.rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    fields = [StructField(name, DoubleType(), False) for name in FEATURES]
    found = common.over_texts(rows, ["doc_id", "label"], "text", features_of, fields)
    table = found.select("row.doc_id", F.col("row.label").alias("y"), *FEATURES).toPandas()
    # In a fixed order, so that sums over rows come out the same in every run.
    table = table.sort_values(["doc_id", "y", *FEATURES])
    return fit(table[FEATURES].to_numpy(float), table["y"].to_numpy(float), how)


def scored(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """``row`` (the carried columns), score and predicted (score >= 0.5), one row per input row.

    Null texts count as empty and are scored too; repeated rows get the same score each. A whole
    text is measured, however long. Columns are carried in ``row``, so none can clash; an empty
    table gives no rows.
    """
    def measure(texts: list[bytes]) -> list:
        p = score(model, np.array([features_of(t) for t in texts]))
        return [p, (p >= 0.5).astype(np.int32)]

    fields = [StructField("score", DoubleType(), False), StructField("predicted", IntegerType(), False)]
    return common.over_batches(docs, carry, text, measure, fields)


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model predicts to be good, with their own columns."""
    return scored(docs, model, docs.columns, text).filter("predicted = 1").select("row.*")
