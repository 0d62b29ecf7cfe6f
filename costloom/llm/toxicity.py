"""Toxicity as a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its lower-cased characters, hashed
to buckets. On the training sample Spark counts in how many toxic and clean
texts every bucket occurs; the log of the two smoothed rates is the bucket's
ratio. The buckets with the strongest evidence become the features, each worth
its ratio where present, and logistic regression weighs them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, kept, remainder

ORDERS = (3, 4, 5)
BITS = 22  # buckets, as a power of two
BLOCK = 250_000  # characters hashed at once
SMOOTH = 1.0
PARTS = 256  # of a class, ranked apart


def char_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and where each text starts; a space parts them."""
    joined = [f" {x.lower()} " for x in texts]
    ends = np.cumsum([len(x) for x in joined])
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes >= 9) & (codes <= 13)] = 32
    return codes, np.concatenate([[0], ends]).astype(np.int64)


def buckets(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For every order, the bucket of the n-gram that starts at each position."""
    for n in ORDERS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        yield (h >> np.uint64(64 - BITS)).astype(np.int64)


def found(texts: list[str], slot: np.ndarray, features: int) -> np.ndarray:
    """Whether each text has each feature; ``slot`` is a bucket's feature, or -1."""
    out = np.zeros((len(texts), features), bool)
    for lo, hi in blocks([len(x) for x in texts], BLOCK):
        codes, starts = char_codes(texts[lo:hi])
        for n, b in zip(ORDERS, buckets(codes), strict=False):
            s = slot[b]
            at = np.flatnonzero(s >= 0)
            row = np.searchsorted(starts, at, side="right") - 1
            inside = at + n <= starts[row + 1]
            out[lo + row[inside], s[at[inside]]] = True
    return out


@dataclass
class Model:
    """``chosen`` buckets in order, the value of each where present, and the intercept."""

    chosen: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        slot = np.full(1 << BITS, -1, np.int32)
        slot[self.chosen] = np.arange(len(self.chosen))
        return self._score(texts, slot)

    def _score(self, texts: list[str], slot: np.ndarray) -> np.ndarray:
        out = np.empty(len(texts))
        for i in range(0, len(texts), 100):
            part = texts[i : i + 100]
            out[i : i + 100] = found(part, slot, len(self.chosen)) @ self.weight + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 400, counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights of L2-regularised logistic regression by Nesterov's accelerated gradient; a row counts ``counts`` times, else once."""
    x = x.astype(np.float32, copy=False)
    n = max(1, len(y))
    own = np.ones(len(y), np.float32) if counts is None else (counts * (n / counts.sum())).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # largest curvature, by power iteration
        v = x.T @ (own * (x @ v))
        size = float(np.linalg.norm(v))
        if not size:
            break
        v /= size
    step = 1.0 / (0.25 * (size if x.shape[1] else 0.0) / n + ridge + 0.25)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    aw, ab = w, b
    for t in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ aw + ab, -60, 60)))
        g = (own * (p - y)).astype(np.float32)
        nw, nb = aw - step * (x.T @ g / n + ridge * aw), ab - step * float(g.mean())
        m = t / (t + 3)
        aw, ab = nw + m * (nw - w), nb + m * (nb - b)
        w, b = nw, nb
    return w.astype(np.float64), float(b)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, features: int = 8192, ridge: float = 1e-3) -> Model:
    """Classifier of ``docs`` (doc_id, text) labelled by ``labels`` (doc_id, toxic).

    The sample is bounded: ``per_class`` labelled documents of each class in the
    order of a hash of the id, each standing for as many as its class has for one
    sampled, so the fit sees the true class shares whether the bound cuts or not.
    Labels other than 0 and 1 are left out; a document labelled twice is toxic if
    any label says so. Without both classes there are
    no features, and the score is the share of toxic documents, or 0.
    """
    marked = labels.filter("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.join(docs.filter("text is not null").select("doc_id"), "doc_id", "left_semi")
    marked = kept(marked, "toxicity-labels")
    # All documents of each class that can be learned from, before the bound.
    every = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    # Ranked in parts first: no task holds a whole class, and the last rank sees at most PARTS * per_class rows of one.
    picked = marked.withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS)))
    for within in (["toxic", "part"], ["toxic"]):
        rank = F.row_number().over(Window.partitionBy(*within).orderBy(F.xxhash64("doc_id"), F.col("doc_id")))
        picked = picked.withColumn("n", rank).filter(F.col("n") <= per_class).drop("n")
    picked = picked.select("doc_id", "toxic")
    # At most 2 * per_class rows of two numbers, so a broadcast is safe.
    sample = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    sample = kept(sample.dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic"), "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            totals = np.zeros((2, 1 << BITS), np.int32)
            for x, y in zip(pdf.text, pdf.toxic, strict=True):
                codes, _ = char_codes([x])
                own = [b for b in buckets(codes)]
                if own:
                    totals[y, np.unique(np.concatenate(own))] += 1
            at = np.flatnonzero(totals.any(axis=0))
            yield pd.DataFrame({"bucket": at, "toxic": totals[1, at], "clean": totals[0, at]})

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        odds = np.log(n1 + 1e-9) - np.log(n0 + 1e-9) if n1 or n0 else -50.0
        return Model(np.zeros(0, np.int64), np.zeros(0), float(odds))
    counted = sample.mapInPandas(count, "bucket long, toxic long, clean long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = F.log((F.col("toxic") + SMOOTH) / (n1 + 2 * SMOOTH)) - F.log((F.col("clean") + SMOOTH) / (n0 + 2 * SMOOTH))
    strength = F.abs("ratio") * F.sqrt(F.col("toxic") + F.col("clean"))
    best = counted.withColumn("ratio", ratio).filter(F.col("toxic") + F.col("clean") >= 3).orderBy(strength.desc(), "bucket").limit(features).collect()
    best.sort(key=lambda r: r["bucket"])
    chosen, ratios = np.array([r["bucket"] for r in best], np.int64), np.array([r["ratio"] for r in best])

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot = np.full(1 << BITS, -1, np.int32)
        slot[chosen] = np.arange(len(chosen))
        for pdf in batches:
            bits = np.packbits(found(list(pdf.text), slot, len(chosen)), axis=1)
            yield pd.DataFrame({"doc_id": pdf.doc_id, "toxic": pdf.toxic, "bits": [r.tobytes() for r in bits]})

    # Per sampled document one bit a feature: its size does not depend on its text.
    rows = sample.mapInPandas(present, "doc_id long, toxic int, bits binary").orderBy("doc_id").collect()
    y = np.array([r["toxic"] for r in rows], np.float32)
    x = np.zeros((len(rows), len(chosen)), np.float32)  # the one large array: 4 bytes a feature and sampled row
    for i, r in enumerate(rows):
        x[i] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=len(chosen))
    x *= ratios.astype(np.float32)
    weight, bias = logistic(x, y, ridge, counts=np.where(y > 0, every[1] / n1, every[0] / n0))
    return Model(chosen, weight * ratios, bias)


def classify(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic; a NULL text counts as an empty one."""
    chosen, weight, bias = model.chosen, model.weight, model.bias

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(chosen, weight, bias)
        slot = np.full(1 << BITS, -1, np.int32)
        slot[chosen] = np.arange(len(chosen))
        for batch in batches:
            yield pd.Series(own._score([x if isinstance(x, str) else "" for x in batch], slot))

    return docs.withColumn(score, rate(F.col(text)))


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the documents whose crc32(doc_id) modulo 5 is not 0."""
    train = docs.filter(remainder("doc_id", 5) != 0).select("doc_id", "text")
    return fit(train, labels.select("doc_id", "toxic").filter(remainder("doc_id", 5) != 0))


def predict_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted; a row without an id is scored and never learned from."""
    rows = docs.select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    out = classify(rows, learned(docs, labels))
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
