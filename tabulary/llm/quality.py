"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network that minimises
the non-negative unbiased risk: with the class prior p,

    p * R(positives are 1) + max(0, R(unlabelled are 0) - p * R(positives are 0)).

Where the bracket falls below zero, the step climbs it instead, so the network
cannot memorise positives. The loss is logistic, hence the output estimates the
probability of label 1. Features are of style: frequencies of ASCII characters,
transitions between kinds of characters, and a few counts over words and lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, map_arrow, slices, span_hashes, words

#: Rows of each kind, about, that the network is fitted on.
TRAINING_ROWS = 8000

#: Kinds of bytes: space, line end, lower, upper, digit, full stop and comma, other ASCII punctuation, other.
_KINDS = 8
_KIND = np.full(256, 6, np.int64)
_KIND[0x00:0x21] = 0
_KIND[0x0A] = 1
_KIND[0x61:0x7B] = 2
_KIND[0x41:0x5B] = 3
_KIND[0x30:0x3A] = 4
_KIND[[0x2C, 0x2E]] = 5
_KIND[0x80:] = 7
N_FEATURES = 129 + _KINDS**2 + 8


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Style features of each text of a slice; all 0 for an empty text."""
    n = len(at) - 1
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(data):
        return out
    size = np.diff(at)
    some = np.flatnonzero(size)
    for d in some:
        piece = data[at[d] : at[d + 1]]
        freq = np.bincount(np.minimum(piece, 128), minlength=129)
        kind = _KIND[piece]
        moves = np.bincount(kind[:-1] * _KINDS + kind[1:], minlength=_KINDS**2)
        out[d, :129] = np.sqrt(freq / len(piece))
        out[d, 129 : 129 + _KINDS**2] = np.sqrt(moves / len(piece))
    hashes, starts, first = words(data, at, SPACED)
    lines = _line_hashes(data, at)
    k = 129 + _KINDS**2
    for d in some:
        own = hashes[first[d] : first[d + 1]]
        if len(own):
            distinct = len(np.unique(own))
            out[d, k] = distinct / len(own)
            out[d, k + 1] = distinct / np.sqrt(len(own)) / 20
            out[d, k + 2] = np.minimum(size[d] / len(own), 40) / 10
            out[d, k + 3] = np.mean(own[1:] == own[:-1]) if len(own) > 1 else 0
        rows = lines[d]
        out[d, k + 4] = 1 - len(np.unique(rows)) / max(1, len(rows))
        out[d, k + 5] = np.log1p(len(own)) / 10
        out[d, k + 6] = np.log1p(len(rows)) / 10
        out[d, k + 7] = np.log1p(len(own) / max(1, len(rows))) / 5
    return out


def _line_hashes(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    cuts = np.unique(np.concatenate([at, np.flatnonzero(data == 0x0A) + 1]))
    hashes = span_hashes(data, cuts[:-1], cuts[1:])
    bounds = np.searchsorted(cuts, at)
    return [hashes[bounds[d] : bounds[d + 1]] for d in range(len(at) - 1)]


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -30, 30)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, epochs: int = 40, rate: float = 3e-3, decay: float = 1e-3, seed: int = 7) -> Network:
    """Minimise the non-negative risk by Adam over batches."""
    rng = np.random.default_rng(seed)
    if not len(positive) or not len(unlabelled):
        return Network(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), float(np.log(prior / (1 - prior))) if 0 < prior < 1 else 0.0, prior)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    par = [rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(x) for x in par], [np.zeros_like(x) for x in par], 0
    batches = max(1, (len(p) + len(u)) // 512)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(epochs):
        cut_p, cut_u = np.array_split(rng.permutation(len(p)), batches), np.array_split(rng.permutation(len(u)), batches)
        for bp, bu in zip(cut_p, cut_u):
            if not len(bp) or not len(bu):
                continue
            x = np.concatenate([p[bp], u[bu]])
            h = np.tanh(x @ par[0] + par[1])
            z = h @ par[2] + par[3][0]
            zp, zu = z[: len(bp)], z[len(bp) :]
            as_negative = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
            to_p, to_u = sigmoid(zp) / len(bp), sigmoid(zu) / len(bu)
            if as_negative >= 0:
                g = np.concatenate([-prior * sigmoid(-zp) / len(bp) - prior * to_p, to_u])
            else:
                g = np.concatenate([prior * to_p, -to_u])
            back = np.outer(g, par[2]) * (1 - h * h)
            grads = [x.T @ back + decay * par[0], back.sum(axis=0), h.T @ g + decay * par[2], np.array([g.sum()])]
            step += 1
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                par[i] = par[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, par[0], par[1], par[2], float(par[3][0]), prior)


def _draw(salt: str, share: float):
    return F.pmod(F.xxhash64(F.lit(salt), F.coalesce("doc_id", F.lit(-1))), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def _sampled(docs: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            x = features(data, at)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

    rows = map_arrow(docs.select("doc_id", "text"), run, "doc_id long, x binary").collect()
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))  # the fit must not depend on the order of arrival
    return np.array([np.frombuffer(r[1], np.float32) for r in rows], np.float64).reshape(len(rows), N_FEATURES)


def fit(docs: DataFrame, labels: DataFrame, rows_each: int = TRAINING_ROWS, prior: float | None = None) -> Network:
    """Learn from ``labels`` (doc_id, quality) and the texts of ``docs`` (doc_id, text).

    About ``rows_each`` positives and as many unlabelled documents are drawn by
    hashed id; the driver holds their features and nothing else. The prior is,
    unless given, the share of label 1 among the labelled documents. A document
    with both labels is no trusted positive. Labels that are null are ignored.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n, good = known.agg(F.count("*"), F.coalesce(F.sum("quality"), F.lit(0))).collect()[0]
    if prior is None:
        prior = min(0.99, max(0.01, (good + 1) / (n + 2)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the drawn ids number about rows_each at any size of input
    trusted = known.where("quality = 1").where(_draw("trusted", rows_each / max(1, good))).select("doc_id")
    positive = _sampled(texts.join(F.broadcast(trusted), "doc_id", "left_semi"))
    unlabelled = _sampled(texts.where(_draw("unlabelled", rows_each / max(1, texts.count()))))
    return train(positive, unlabelled, prior)


def score(docs: DataFrame, network: Network, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every whole text; a null text is an empty one.

    The score of the empty text is what the network makes of features that are
    all 0. Repeated rows are scored each; an empty table gives no rows; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some thousand numbers
    picked = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.score(features(data, at)), pa.float64())], names=["doc_id", "score"])

    return map_arrow(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, score double")
