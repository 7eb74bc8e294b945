"""Document quality by Bradley-Terry ranking.

A document is a vector of rates (symbols, capitals, repeated words and lines, word lengths and so on). From labelled rows
come preference pairs, a good document over a bad one; logistic loss on the difference of their vectors gives weights, so
that the weighted sum is a score by which any two documents compare. The threshold is the score quantile at the share of
bad rows among those learnt from, and the score that leaves the operator is a logistic curve through 0.3 at that quantile.

Only the learning sample is bounded: at most SAMPLE rows a label, taken in the order of a hash of the id. Every text is
scored whole, in one pass without a shuffle.

Defined results: null text counts as empty; an empty text has a vector of zeros and a score like any other; a null id
belongs to the fold of the empty string; rows whose label is null are not learnt from; of repeated labels of one id the
smallest counts; without rows of both labels every score is 0.5; repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, documents, filtered, fold, labels, map_batches, texts

#: Learnt from at most: rows of each label, and pairs drawn from them.
SAMPLE, PAIRS = 3000, 60_000
CUT = 0.3
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CAPITALS, _DIGITS, _SPACES, _ENDS = (np.isin(np.arange(256), list(x)) for x in (range(65, 91), range(48, 58), b" \t\n\x0b\x0c\r", b".,;:?'\"-()"))
_SYMBOLS = ~(_LETTERS | _DIGITS | _SPACES | _ENDS) & (np.arange(256) > 32)
WIDTH = 15


def features(text: bytes) -> np.ndarray:
    """Rates of a whole text, each from 0 to about 3."""
    out = np.zeros(WIDTH)
    words = text.split()
    if not words:
        return out
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, m, lines = len(text), len(words), text.split(b"\n")
    kinds = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    symbols = count[_SYMBOLS]
    out[:] = (
        symbols.sum() / m, symbols.max() / m, count[_CAPITALS].sum() / m, count[_DIGITS].sum() / m, count[_ENDS].sum() / m, again / m, 1 - kinds / m, 1 - len(set(lines)) / len(lines),
        count[_LETTERS].sum() / n, n / m / 10, count[124] / m, count[33] / m, np.log1p(m) / 5, np.log1p(m / kinds), m / len(lines) / 100,
    )
    return np.concatenate([np.log1p(20 * np.minimum(out[:8], 5)), np.minimum(out[8:], 3)])


@dataclass
class Ranking:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; CUT exactly where the raw score is the threshold."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.threshold + np.log(CUT / (1 - CUT)), -30, 30)))


def learn(x: np.ndarray, y: np.ndarray, bad_share: float | None = None, seed: int = 4, steps: int = 60, ridge: float = 1e-3) -> Ranking | None:
    """Bradley-Terry weights by Newton steps over pairs of a row with y 1 and one with y 0."""
    good, bad = x[y == 1], x[y == 0]
    if not len(good) or not len(bad):
        return None
    centre, scale = x.mean(0), x.std(0) + 1e-6
    rng = np.random.default_rng(seed)
    d = (good[rng.integers(0, len(good), PAIRS)] - bad[rng.integers(0, len(bad), PAIRS)]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance that the pair is ranked wrongly
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / PAIRS + (ridge + 1e-9) * np.eye(len(w)), d.T @ p / PAIRS - ridge * w)
        w += step * min(1, 2 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    made = Ranking(centre, scale, w, 0.0)
    share = len(bad) / len(x) if bad_share is None else bad_share
    raw = np.concatenate([made.raw(good), made.raw(bad)])
    weight = np.concatenate([np.full(len(good), (1 - share) / len(good)), np.full(len(bad), share / len(bad))])
    order = np.argsort(raw, kind="stable")
    below = np.searchsorted(np.cumsum(weight[order]), share)
    made.threshold = float(raw[order[[min(below, len(raw) - 1), min(below + 1, len(raw) - 1)]]].mean())
    return made


def sample(docs: DataFrame, marks: DataFrame, label: str, at_most: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, int]:
    """The texts to learn from with their label y, at most at_most rows of each label; how many rows bear label 0 and 1."""
    marks = marks.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna().groupBy("doc_id").agg(F.min("y").alias("y")).filter("y IN (0, 1)")
    total = {r.y: r["count"] for r in marks.groupBy("y").count().collect()}
    some = [marks.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most) for y in (0, 1)]
    chosen = some[0].union(some[1])  # 2 * at_most rows at most, so they can be broadcast
    rows = texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return rows, total.get(0, 0), total.get(1, 0)


def fitted(docs: DataFrame, marks: DataFrame, learn_from: Column | None = None, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", at_most: int = SAMPLE) -> Ranking | None:
    """learn_from: which rows of marks may be learnt from."""
    rows, n0, n1 = sample(docs, marks if learn_from is None else marks.filter(learn_from), label, at_most, id_col, text_col)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([features(t).tolist() for t in as_bytes(b.column("text"))], pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    got = sorted(map_batches(rows, vectors, "doc_id bigint, y int, x array<double>").collect())  # 2 * at_most short rows at most
    if not got:
        return None
    return learn(np.array([r.x for r in got]), np.array([r.y for r in got]), n0 / max(1, n0 + n1))


def scored(docs: DataFrame, model: Ranking | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted for each row of docs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(np.array([features(t) for t in as_bytes(b.column("text"))]).reshape(-1, WIDTH)) if model else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_batches(texts(docs, id_col, text_col), score, "doc_id bigint, score double, predicted int")


def kept(docs: DataFrame, model: Ranking | None, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not rejected, with all their columns; all without a model."""
    return filtered(docs, lambda found: (model.score(np.array([features(t) for t in found]).reshape(-1, WIDTH)) >= CUT).tolist(), text_col) if model else docs


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fitted(docs, labels(spark, sf_dir), fold("doc_id", 5) != 0)
    return scored(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
