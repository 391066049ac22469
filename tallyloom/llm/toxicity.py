"""Toxicity by non-negative positive-unlabelled learning: confirmed toxic texts against unlabelled ones, with a linear model in numpy."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import whole_texts

BITS = 20
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»„“”‘’¡¿…"


def word_features(piece: str) -> tuple[int, ...]:
    """Hashed features of a blank-separated piece: the word without its outer punctuation, and its beginnings of 4 to 6 letters."""
    word = piece.lower().strip(_EDGES)
    if not word:
        return ()
    forms = ["=" + word, *("^" + word[:n] for n in (4, 5, 6) if len(word) >= n)]
    return tuple({zlib.crc32(form.encode("utf-8", "replace")) & ((1 << BITS) - 1) for form in forms})


class Featurizer:
    """Feature values of texts, restricted to ``kept`` if given; remembers at most ``limit`` pieces."""

    def __init__(self, kept: frozenset[int] | None = None, limit: int = 100_000):
        self._kept, self._limit = kept, limit
        self._known: dict[str, tuple[int, ...]] = {}

    def values(self, text: str) -> tuple[list[int], np.ndarray]:
        """Features of a text and ``log(1 + count) / sqrt(1 + pieces)`` of each."""
        pieces = Counter(text.split())
        counts: dict[int, int] = {}
        known = self._known
        for piece, n in pieces.items():
            features = known.get(piece)
            if features is None:
                features = word_features(piece)
                if self._kept is not None:
                    features = tuple(f for f in features if f in self._kept)
                if len(known) >= self._limit:
                    known.clear()
                if len(piece) <= 48:
                    known[piece] = features
            for f in features:
                counts[f] = counts.get(f, 0) + n
        return list(counts), np.log1p(np.fromiter(counts.values(), np.float64, len(counts))) / np.sqrt(1 + pieces.total())


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of hashed features; ``score`` is 0.7 where the logit equals ``threshold``."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -4.0
    threshold: float = 0.0
    scale: float = 1.0

    def score(self, logit: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * (logit - self.threshold) + np.log(0.7 / 0.3), -30, 30))))


class Scorer:
    """Scores of single texts by a model."""

    def __init__(self, model: ToxicityModel):
        self._model, self._featurizer = model, Featurizer(frozenset(model.weights))

    def score(self, text: str) -> float:
        features, values = self._featurizer.values(text)
        weights = self._model.weights
        return self._model.score(self._model.bias + sum(weights[f] * v for f, v in zip(features, values.tolist())))


def fit_non_negative_pu(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, positive: np.ndarray, prior: float, turns: int = 300, rate: float = 0.3, decay: float = 1e-5):
    """Weights and bias that minimise the non-negative risk of a sparse sample given as triples.

    ``positive`` tells confirmed rows from unlabelled ones. The risk is ``prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))``
    with the logistic loss; while the second term is negative, its gradient is taken the other way round. Full batches, Adam.
    """
    n, d = len(positive), int(columns.max(initial=-1)) + 1
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    w[d] = np.log(prior / (1 - prior))
    share_p, share_u = positive / max(1, positive.sum()), ~positive / max(1, (~positive).sum())
    for turn in range(1, turns + 1):
        z = np.bincount(rows, w[columns] * values, n) + w[d]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        negative = np.logaddexp(0, z)
        rest = share_u @ negative - prior * (share_p @ negative)
        if rest >= 0:
            g = prior * share_p * (p - 1) + (share_u - prior * share_p) * p
        else:
            g = -(share_u - prior * share_p) * p
        gradient = np.append(np.bincount(columns, g[rows] * values, d) + decay * w[:d], g.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return w[:d], w[d]


def fit_toxicity(docs: DataFrame, labels: DataFrame, is_train: Column, positives: int = 1500, unlabelled: int = 4500, features: int = 4096, key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """A model from confirmed toxic texts and unlabelled ones among the rows of ``is_train``, a condition on the key.

    The sample holds at most ``positives`` and ``unlabelled`` texts, the first by a hash of the key; the other labels only give the class
    prior. ``features`` are chosen by how far their rates in the two parts are apart. Without a toxic label, or without
    texts, the model finds everything clean. A document with several labels counts as toxic if one says so.
    """
    known = labels.where(is_train & F.col(key).isNotNull() & F.col("toxic").isNotNull()).groupBy(key).agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    by_hash = F.xxhash64(F.col(key).cast("string"))
    toxic = known.where("toxic = 1").orderBy(by_hash, key).limit(positives).select(key, F.lit(True).alias("positive"))
    others = docs.where(is_train & F.col(key).isNotNull()).select(key).orderBy(by_hash, key).limit(unlabelled).select(key, F.lit(False).alias("positive"))
    wanted: dict = {}
    for row in toxic.unionByName(others).collect():
        wanted.setdefault(row[key], []).append(row["positive"])
    if not prior or not wanted:
        return ToxicityModel()
    session = docs.sparkSession
    keys = session.createDataFrame([(name,) for name in wanted], docs.select(key).schema)
    sample = whole_texts(docs, key, text).join(F.broadcast(keys), key)
    d = 1 << BITS

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer()
        for batch in batches:
            found = [featurizer.values(value.as_py()) for value in batch.column(1)]
            blobs = [np.array(f, "<i4").tobytes() for f, _ in found], [v.astype("<f4").tobytes() for _, v in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(blob, pa.binary()) for blob in blobs)], names=[key, "f", "v"])

    got = sample.mapInArrow(featurize, f"`{key}` {sample.schema[key].dataType.simpleString()}, f binary, v binary").collect()
    seen: dict = {}
    for row in got:
        seen.setdefault(row[key], row)  # of repeated keys one text is enough
    parts = [(seen[name], flag) for name, flags in wanted.items() if name in seen for flag in flags]
    positive = np.array([flag for _, flag in parts], bool)
    if not positive.any():
        return ToxicityModel()
    columns = np.concatenate([np.frombuffer(row["f"], "<i4") for row, _ in parts])
    values = np.concatenate([np.frombuffer(row["v"], "<f4") for row, _ in parts]).astype(np.float64)
    rows = np.repeat(np.arange(len(parts)), [len(row["f"]) // 4 for row, _ in parts])
    in_p = np.bincount(columns[positive[rows]], minlength=d) / positive.sum()
    in_u = np.bincount(columns[~positive[rows]], minlength=d) / max(1, (~positive).sum())
    apart = (in_p - in_u) / np.sqrt(in_p + in_u + 5 / len(parts))
    chosen = np.argsort(-np.abs(apart))[:features]
    place = np.full(d, -1)
    place[chosen] = np.arange(len(chosen))
    of = place[columns] >= 0
    rows, columns, values = rows[of], place[columns[of]], values[of]
    weights, bias = fit_non_negative_pu(rows, columns, values, positive, prior)
    z = np.bincount(rows, np.append(weights, np.zeros(len(chosen) - len(weights)))[columns] * values, len(parts)) + bias
    threshold = best_threshold(z, positive, prior)
    spread = max(1e-3, float(np.median(z[positive])) - threshold)
    return ToxicityModel({int(f): float(w) for f, w in zip(chosen, weights) if w}, float(bias), threshold, 3.0 / spread)


def best_threshold(z: np.ndarray, positive: np.ndarray, prior: float) -> float:
    """The middle of the widest range of thresholds with the least positive-unlabelled estimate of the error rate."""
    grid = np.linspace(z.min() - 1e-6, z.max() + 1e-6, 4001)
    of_p, of_u = np.sort(z[positive]), np.sort(z[~positive])
    hit_p = 1 - np.searchsorted(of_p, grid) / len(of_p)
    hit_u = 1 - np.searchsorted(of_u, grid) / max(1, len(of_u))
    error = prior * (1 - hit_p) + np.maximum(0, hit_u - prior * hit_p)
    best = np.flatnonzero(error <= error.min() + 1e-4)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    run = max(runs, key=len)
    return float((grid[run[0]] + grid[run[-1]]) / 2)


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``key, score`` of every text. The model, at most ``features`` weights, travels with the task.

    Null and empty texts score as texts without known words; repeated rows are scored each; an empty table gives no rows; other columns are
    not read.
    """
    slim = whole_texts(docs, key, text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[key, "score"])

    return slim.mapInArrow(score, f"`{key}` {slim.schema[key].dataType.simpleString()}, score double")


def keep_below(docs: DataFrame, model: ToxicityModel, bound: float, text: str = "text") -> DataFrame:
    """All columns of the rows whose text scores below ``bound``.

    Null and empty texts score as texts without known words; repeated rows and rows without a key are judged each; an empty table gives no
    rows; other columns are kept as they are.
    """

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for values in parts:
            yield values.map(lambda value: scorer.score(value or ""))

    return docs.where(score(F.col(text)) < bound)


def is_held_out(key: str = "doc_id") -> Column:
    """The third of the rows whose labels are never learned: CRC-32 of the key as text, remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
