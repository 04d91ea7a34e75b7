"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words, pairs of neighbours and pairs that skip one word are hashed into 2**bits coordinates; a document's features are the distinct ones,
each with value 1. Training follows the per-coordinate rates and the L1/L2 terms of FTRL-proximal, so most weights stay exactly 0: the model is
the list of the others, a few thousand numbers whatever the corpus, and goes to the tasks with the code.

The model is fitted on a bounded sample of labelled rows (``max_rows``, chosen by hash of the id); every document is scored on its whole text.
Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts get the score of the bias alone; rows without a label, or with a null one, train nothing; a document
labelled twice counts once, as toxic if any row says so; without labels every score is 0.5 (or the bias); equal texts get equal scores; an empty table gives an
empty result; clashing columns are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WORD = re.compile(r"\w+")
#: Odd multipliers that mix the hashes of two words.
MIX_A, MIX_B, MIX_SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 15.0
    l2: float = 1.0
    epochs: int = 4
    #: The most labelled rows that the model is fitted on.
    max_rows: int = 8000
    threshold: float = 0.3


class Features:
    """Distinct hashed coordinates of a text; word hashes are remembered in a bounded table."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = WORD.findall((text or "").lower())
        if not words:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > 300_000:
            known.clear()
        hashes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        a = np.array(hashes, np.uint64)
        with np.errstate(over="ignore"):
            parts = [a * MIX_A, (a[:-1] * MIX_A + a[1:]) * MIX_B, (a[:-2] * MIX_A + a[2:]) * MIX_SKIP]
        return np.unique(np.concatenate(parts) >> self.shift).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Coordinates with a weight, sorted, their weights, and the bias."""

    at: np.ndarray
    weights: np.ndarray
    bias: float
    settings: Settings

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.settings.bits, np.float32)
        w[self.at] = self.weights
        return w


def fit(texts: list, labels: list[int], s: Settings = Settings()) -> Model:
    features = Features(s.bits)
    rows = [features(t) for t in texts]
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    zb = nb = 0.0

    def weight(z, n):
        return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def bias():
        return -zb / ((s.beta + nb**0.5) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for k in order.permutation(len(rows)):
            x = rows[k]
            w, b = weight(z[x], n[x]), bias()
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -30, 30)))
            g = p - labels[k]
            sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / s.alpha
            z[x] += g - sigma * w
            n[x] += g * g
            sb = ((nb + g * g) ** 0.5 - nb**0.5) / s.alpha
            zb += g - sb * b
            nb += g * g
    w = weight(z, n)
    at = np.nonzero(w)[0]
    return Model(at, w[at].astype(np.float32), float(bias()), s)


def held_out():
    """Rows that a model is tested on: their labels are never learned."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """The model of a bounded sample of the labelled rows: at most ``max_rows`` ids, so they can be broadcast and their texts collected."""
    sample = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [r.toxic for r in rows], s)


def score(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted``."""

    def make():
        w, features = model.dense(), Features(model.settings.bits)

        def run(texts):
            v = [float(w[features(t)].sum()) + model.bias for t in texts]
            p = 1.0 / (1.0 + np.exp(-np.clip(np.array(v), -30, 30)))
            return {"score": p, "predicted": (p >= model.settings.threshold).astype(np.int32)}

        return run

    return common.map_text(df, column, "score double, predicted int", make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
