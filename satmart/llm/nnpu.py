"""Toxicity from confirmed toxic texts plus unlabelled text: non-negative positive-unlabelled
learning. The risk of a linear model is put together from positives and unlabelled texts through
the class prior; where its negative part falls below zero, which is overfitting, the step goes
the other way."""

from __future__ import annotations

import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from satmart.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_"


@dataclass(frozen=True)
class Fit:
    """Bounds on training rows, and how to descend. A null prior is estimated from the labels."""

    positives: int = 5_000
    unlabelled: int = 10_000
    features: int = 2_048
    least_positives: int = 4
    least_gain: float = 8.0
    least_ratio: float = 3.0
    prior: float | None = None
    steps: int = 600
    rate: float = 0.05
    decay: float = 1e-4
    slack: float = 0.0


@dataclass(frozen=True)
class Model:
    prior: float
    bias: float
    weights: dict[int, float]


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings, which survive inflection."""
    core = word.strip(_EDGES)
    if not core:
        return ()
    letters = core.decode("utf-8", "replace")
    starts = [letters[:n].encode() for n in (4, 5, 6) if len(letters) >= n]
    return (zlib.crc32(b"w" + core), *(zlib.crc32(b"p" + s) for s in starts))


def _lower(raw: bytes) -> bytes:
    return raw.decode("utf-8", "replace").lower().encode("utf-8", "replace")


def feature_set(raw: bytes) -> set[int]:
    found: set[int] = set()
    for word in set(_lower(raw).split()):
        found.update(word_features(word))
    return found


def fit(hits: list[np.ndarray], positive: np.ndarray, n: int, prior: float, how: Fit):
    """Weights and bias from the features each text holds (numbers below n).

    Logistic loss. Positives count with the prior; R_u - prior * R_p stands for the risk of the
    negatives, kept from falling below ``slack``.
    """
    rows = np.repeat(np.arange(len(hits)), [h.size for h in hits])
    cols = np.concatenate([*hits, np.empty(0, np.int64)]).astype(np.int64)
    n_pos, n_unl = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    theta = np.zeros(n + 1)
    theta[n] = np.log(prior / (1 - prior))
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, how.steps + 1):
        z = np.bincount(rows, theta[cols], len(hits)) + theta[n]
        up = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        as_negative = np.logaddexp(0, z)
        rest = as_negative[~positive].sum() / n_unl - prior * as_negative[positive].sum() / n_pos
        # d/dz of log(1+e^-z) is up-1, of log(1+e^z) is up.
        slope_rest = np.where(positive, -prior * up / n_pos, up / n_unl)
        slope_pos = np.where(positive, prior * (up - 1) / n_pos, 0.0)
        slope = slope_pos + slope_rest if rest >= -how.slack else -slope_rest
        grad = np.append(np.bincount(cols, slope[rows], n), slope.sum()) + how.decay * theta
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta -= how.rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:n], float(theta[n])


def train(docs: DataFrame, labels: DataFrame, train_rows, stage, how: Fit = Fit()) -> Model:
    """Fits on ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); ``train_rows`` is the
    condition on doc_id for rows that may be learned from.

    Label 0 is read for the class prior only: such texts are unlabelled ones like all others.
    Both samples take the smallest hashes of doc_id, up to the bounds in ``how``; their features
    are counted on the executors, and at most ``features`` of them come to the driver. Without
    labels the prior is a half and no feature is chosen, so every text has the same score; a doc_id
    with labels 0 and 1 counts for the prior twice and is a positive; null labels and ids, and other
    columns, are not read.
    """
    known = labels.filter(F.col("toxic").isNotNull() & train_rows)
    prior = how.prior
    if prior is None:
        got = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).first()
        prior = ((got.k or 0) + 1) / (got.n + 2)

    def smallest(ids: DataFrame, bound: int) -> DataFrame:
        return ids.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)

    chosen = smallest(known.filter("toxic = 1"), how.positives).select(
        "doc_id", F.lit(True).alias("positive")
    ).union(
        smallest(docs.filter(train_rows), how.unlabelled).select("doc_id", F.lit(False))
    )
    sample = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "pu_sample")
    source = sample.select("positive", common.text_bytes("text").alias("text"))

    def features(batches):
        for batch in batches:
            flags, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for flag, text in zip(flags, texts):
                found = pa.array(sorted(feature_set(text)), pa.int64())
                flag_column = pa.array([flag] * len(found), pa.bool_())
                yield pa.RecordBatch.from_arrays([flag_column, found], ["positive", "feature"])

    counted = source.mapInArrow(features, "positive boolean, feature long").groupBy("feature").agg(
        F.count_if(F.col("positive")).alias("p"), F.count_if(~F.col("positive")).alias("u")
    )
    n_pos = max(1, sample.filter("positive").count())
    n_unl = max(1, sample.filter("NOT positive").count())
    # How unlikely so many positives are by chance, in natural logarithms.
    p, chance = F.col("p"), (F.col("p") + F.col("u")) * (n_pos / (n_pos + n_unl))
    gain = F.round(p * F.log(p / chance) - (p - chance), 6)
    ratio = (p / n_pos) / ((F.col("u") + 0.5) / n_unl)
    telling = (gain >= how.least_gain) & (ratio >= how.least_ratio)
    best = (
        counted.filter((p >= how.least_positives) & telling)
        .orderBy(gain.desc(), "feature").limit(how.features)
    )
    number = {r.feature: i for i, r in enumerate(best.select("feature").collect())}

    def found_in(batches):
        for batch in batches:
            for flag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = sorted(number[f] for f in feature_set(text) if f in number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flag], pa.bool_()), pa.array([held], pa.list_(pa.int64()))],
                    ["positive", "held"])

    rows = source.mapInArrow(found_in, "positive boolean, held array<long>").collect()
    rows.sort(key=lambda r: (r.positive, r.held))
    hits = [np.array(r.held, np.int64) for r in rows]
    positive = np.array([r.positive for r in rows], bool)
    weights, bias = fit(hits, positive, len(number), prior, how)
    return Model(prior, bias, {f: float(weights[i]) for f, i in number.items()})


def scored(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """``row`` (the carried columns), score (0 to 1) and predicted (score >= 0.7) per input row.

    Null texts count as empty and get the score of a text without any feature. A whole text is
    read, however long; each distinct word of a batch is hashed once. Repeated rows get the same
    score each, carried columns cannot clash, an empty table gives no rows.
    """
    weights, bias = model.weights, model.bias

    class Known(dict):
        def __missing__(self, word):
            self[word] = found = tuple(f for f in word_features(word) if f in weights)
            return found

    known = Known()

    def measure(texts: list[bytes]) -> list:
        z = np.empty(len(texts))
        if len(known) > 500_000:
            known.clear()
        for i, raw in enumerate(texts):
            held: set[int] = set()
            for word in set(_lower(raw).split()):
                held.update(known[word])
            z[i] = bias + sum(weights[f] for f in sorted(held))
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        return [p, (p >= 0.7).astype(np.int32)]

    fields = [StructField("score", DoubleType(), False), StructField("predicted", IntegerType(), False)]
    return common.over_batches(docs, carry, text, measure, fields)
