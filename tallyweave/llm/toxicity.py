"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over word and word-beginning features is trained with numpy
from confirmed toxic texts and unlabelled ones. The risk on negatives is
estimated from the unlabelled texts, corrected by the class prior, and kept
from turning negative (Kiryo et al., 2017). Features of the two bounded samples
are made on the executors; every text is scored whole where it lies.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold

#: Bounds of the two samples that the classifier is fitted on, in rows.
POSITIVES, UNLABELLED = 3000, 6000
FOLDS = 5
PREFIXES = (4, 5, 6)
#: A feature is kept if so many confirmed texts have it, so many standard errors more often than unlabelled ones.
LEAST_TEXTS, LEAST_Z = 4, 5.0
EPOCHS, BATCHES, RATE, DECAY = 120, 2, 0.05, 5e-5
#: Tokens whose features are remembered at a time by one Python worker.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]
    prior: float


def features_of(token: str) -> tuple[int, ...]:
    """Hashed features of a lower-case token: its letters as a word, and its beginnings."""
    word = token if token.isalpha() else "".join(filter(str.isalpha, token))
    if not word:
        return ()
    return zlib.crc32(b"w" + word.encode()), *(zlib.crc32(b"p" + word[:n].encode()) for n in PREFIXES if len(word) > n)


class Reader:
    """Distinct features of texts; `wanted` keeps only those."""

    def __init__(self, wanted: dict[int, float] | None = None) -> None:
        self.wanted = wanted
        self.known: dict[str, tuple[int, ...]] = {}

    def read(self, text: str | None) -> set[int]:
        found: set[int] = set()
        for token in set(text.lower().split()) if text else ():
            own = self.known.get(token)
            if own is None:
                own = features_of(token)
                if self.wanted is not None:
                    own = tuple(f for f in own if f in self.wanted)
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[token] = own
            if own:
                found.update(own)
        return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def risk_gradient(out: np.ndarray, is_positive: np.ndarray, prior: float) -> np.ndarray:
    """Gradient, by the outputs, of prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)) with the logistic loss."""
    p = is_positive
    loss_neg = np.logaddexp(0, out)
    risk_neg = loss_neg[~p].mean() - prior * loss_neg[p].mean()
    pull_neg = np.where(p, -prior / p.sum(), 1 / (~p).sum()) * sigmoid(out)
    return np.where(p, -prior / p.sum() * sigmoid(-out), 0.0) + (pull_neg if risk_neg >= 0 else 0.0)


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = 7) -> Model:
    """Minimise prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)) with the logistic loss.

    Features are signs of toxicity only: weights are kept at 0 or more.
    """
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(-30.0 if prior <= 0 else 0.0, {}, prior)
    n_p, n_u = len(positive), len(unlabelled)
    seen, in_p = np.unique(np.concatenate(positive), return_counts=True)
    often = in_p >= min(n_p, LEAST_TEXTS)
    seen, in_p, in_u = seen[often], in_p[often], np.zeros(int(often.sum()), dtype=np.int64)
    for x in unlabelled:
        in_u[np.isin(seen, x, assume_unique=True)] += 1
    both = (in_p + in_u) / (n_p + n_u)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_p + 1 / n_u))
    kept = seen[z >= LEAST_Z]
    chosen = [x[np.isin(x, kept, assume_unique=True)] for x in positive + unlabelled]
    lengths = np.array([len(x) for x in chosen])
    rows, cols = np.repeat(np.arange(n_p + n_u), lengths), np.searchsorted(kept, np.concatenate(chosen))
    is_p = np.arange(n_p + n_u) < n_p
    starts = np.searchsorted(rows, np.arange(len(lengths) + 1))
    w, b = np.zeros(len(kept)), 0.0
    m, v, t = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), 0
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        deal = np.concatenate([random.permutation(n_p) * BATCHES // n_p, random.permutation(n_u) * BATCHES // n_u])
        for batch in range(BATCHES):
            own = np.flatnonzero(deal == batch)
            take = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in own]) if len(own) else np.zeros(0, int)
            local = np.repeat(np.arange(len(own)), starts[own + 1] - starts[own])
            out = np.bincount(local, weights=w[cols[take]], minlength=len(own)) + b
            p = is_p[own]
            if not p.any() or p.all():
                continue
            pull = risk_gradient(out, p, prior)
            grad = np.append(np.bincount(cols[take], weights=pull[local], minlength=len(kept)) + DECAY * w, pull.sum())
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = np.maximum(w - step[:-1], 0), b - step[-1]
    return Model(float(b), dict(zip(kept.tolist(), w.tolist(), strict=True)), prior)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A classifier from confirmed toxic rows and unlabelled rows outside fold 0.

    The class prior is the toxic share of the labelled rows outside fold 0. A
    document is confirmed if any of its labels is 1; the samples are the
    documents that come first by a hash of doc_id (ties by doc_id). Of rows with
    one doc_id the least text teaches, once; null ids and null labels teach
    nothing, null and empty texts have no features. Without documents, without
    confirmed ones or without labels the model has no weights and its score is
    the same for all texts (near 0 if no label is 1).
    """
    known = labels.filter((fold("doc_id", FOLDS) != 0) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.select("doc_id").filter((fold("doc_id", FOLDS) != 0) & F.col("doc_id").isNotNull()).distinct()
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    confirmed = known.filter("toxic = 1").join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(positives)
    anyhow = ids.orderBy(order, "doc_id").limit(unlabelled)
    found = known.join(ids, "doc_id", "left_semi").agg(F.avg((F.col("toxic") == 1).cast("int"))).first()[0] or 0.0
    picked = {r.doc_id: 0 for r in anyhow.collect()}
    sure = {r.doc_id for r in confirmed.collect()}
    wanted = docs.sparkSession.createDataFrame([(i,) for i in sorted(sure | set(picked))], docs.select("doc_id").schema)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for batch in batches:
            lists = [np.array(sorted(reader.read(t)), dtype=np.uint32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "features": lists})

    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.mapInPandas(read, "doc_id long, features binary").collect()
    rows = sorted({r.doc_id: bytes(r.features) for r in rows}.items())
    decode = lambda x: np.frombuffer(x, dtype=np.uint32)
    return fit_nnpu([decode(x) for i, x in rows if i in sure], [decode(x) for i, x in rows if i in picked], float(found))


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Score of the whole text, 0 to 1; null and empty texts get the score of no features.

    Each row is scored by its text alone, so repeated rows agree.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        reader = Reader(own.weights)
        for batch in batches:
            total = np.array([own.bias + sum(own.weights[f] for f in sorted(reader.read(t))) for t in batch])
            yield pd.Series(1 / (1 + np.exp(-np.clip(total, -700, 700))), dtype="float64")

    return score(F.col(text))
