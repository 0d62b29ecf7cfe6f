"""Hard negatives by exact integer products of anchors and candidates.

Vectors become whole numbers. Anchors and candidates are cut into blocks of a
bounded number of rows; a task multiplies one block of anchors with one block of
candidates, tile by tile, with Strassen's recursion on int64. Its additions wrap
modulo 2^64, so the product is exact whenever it fits 64 bits itself. From each
tile go only what small heaps of an anchor keep: first the best rows of its own
label (positives), and, once these are known, for each positive the best rows of
other labels inside the window of scores below it. Heaps of all blocks of an
anchor are merged by a top-k window, which Spark limits in every map task.

Blocks of positives hold rows of one label only, so that pass costs the labels'
share of all products; a frequent label has as many blocks as its rows need.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept

SCALE = 256
LEAF = 16  # no dimension of a product is halved below this
ANCHORS = 4096  # anchors of a block, on average
CANDIDATES = (1024, 32_768)  # rows of a block: few while there are under SPREAD blocks, then up to the larger number
SPREAD = 64
TILE = (512, 2048)  # anchors and candidates of one product
LARGEST = 1 << 28  # Euclidean length of a scaled vector; 100 times a product then fits 64 bits


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices by seven products of halves; odd sizes are padded with zeros."""
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) < 2 * leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, l, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :l], a[:i, l:], a[i:, :l], a[i:, l:]
    b11, b12, b21, b22 = b[:l, :j], b[:l, j:], b[l:, :j], b[l:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The first ``k`` (score descending, id ascending) of each of ``n`` lists, fed in any order."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.own = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.least = np.full(n, np.iinfo(np.int64).min)  # a lower score cannot enter

    def merge(self, own: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        own, score, ids = np.concatenate([self.own, own]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, own))
        own, score, ids = own[order], score[order], ids[order]
        place = np.arange(len(own)) - np.searchsorted(own, own)
        first = place < self.k
        self.own, self.score, self.id = own[first], score[first], ids[first]
        full = place == self.k - 1
        self.least[own[full]] = score[full]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def tiles(anchors: pd.DataFrame, rows: pd.DataFrame):
    """(anchors from, to, candidates from, to, their products) over all pairs of two blocks."""
    width = max(map(len, [*anchors.vector, *rows.vector]), default=0)
    a, b = _matrix(anchors.vector, width), _matrix(rows.vector, width).T
    for i in range(0, len(anchors), TILE[0]):
        for j in range(0, len(rows), TILE[1]):
            yield i, j, strassen(a[i : i + TILE[0]], np.ascontiguousarray(b[:, j : j + TILE[1]]))


POSITIVE = "a long, positive_id long, positive_score long"


def best_positives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first ``k`` rows for each anchor, of a block of anchors and one of rows, all of one label."""
    ids, heaps = rows.vec_id.to_numpy(np.int64), Heaps(len(anchors), k)
    own = anchors.vec_id.to_numpy(np.int64)
    for i, j, s in tiles(anchors, rows):
        here = own[i : i + len(s)]
        at, to = np.nonzero((s >= heaps.least[i : i + len(s), None]) & (here[:, None] != ids[None, j : j + s.shape[1]]))
        heaps.merge(at + i, s[at, to], ids[j + to])
    return pd.DataFrame({"a": anchors.a.to_numpy()[heaps.own], "positive_id": heaps.id, "positive_score": heaps.score})


NEGATIVE = "a long, anchor_id long, slot int, positive_id long, positive_score long, negative_id long, negative_score long"


def best_negatives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """The first ``k`` rows of other labels in the window of each positive, of a block of anchors and one of rows."""
    ids, labels = rows.vec_id.to_numpy(np.int64), rows.label.to_numpy(np.int64)
    own = anchors.label.to_numpy(np.int64)
    sizes = np.array([len(p) for p in anchors.positives], np.int64)
    slots = int(sizes.max(initial=0))
    score = np.full((len(anchors), slots), -1, np.int64)  # no window lies below zero
    positive = np.zeros((len(anchors), slots), np.int64)
    for i, found in enumerate(anchors.positives):
        for n, p in enumerate(found):
            score[i, n], positive[i, n] = p["positive_score"], p["positive_id"]
    heaps = [Heaps(len(anchors), k) for _ in range(slots)]
    for i, j, s in tiles(anchors, rows):
        here = slice(i, i + len(s))
        other = own[here, None] != labels[None, j : j + s.shape[1]]
        s = np.where(other, s, -1)
        for n, heap in enumerate(heaps):
            top = score[here, n]
            floor = np.maximum(-(-low * top // 100), heap.least[here])
            at, to = np.nonzero((s >= np.maximum(floor, 0)[:, None]) & (s <= (high * top // 100)[:, None]))
            heap.merge(at + i, s[at, to], ids[j + to])
    out = []
    for n, heap in enumerate(heaps):
        at = heap.own
        out.append(pd.DataFrame({"a": anchors.a.to_numpy()[at], "anchor_id": anchors.vec_id.to_numpy()[at], "slot": np.full(len(at), n, np.int32), "positive_id": positive[at, n], "positive_score": score[at, n], "negative_id": heap.id, "negative_score": heap.score}))
    return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in NEGATIVE.split(", ")})


def prepared(embeddings: DataFrame, anchor_every: int, shift_every: int, labels: int) -> DataFrame:
    """Rows that take part, as whole numbers, each with a number of its own and whether it is an anchor; written once."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = embeddings.filter("vec_id is not null and label is not null and embedding is not null").withColumn("x", x).filter(sound)
    label = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + F.floor(c * SCALE).cast("double") * F.floor(c * SCALE).cast("double")))
    whole = F.when(length <= LARGEST, F.transform("x", lambda c: F.floor(c * SCALE))).otherwise(F.raise_error(F.lit(f"a scaled vector is longer than {LARGEST}")))
    out = rows.select(
        F.monotonically_increasing_id().alias("a"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        whole.alias("vector"),
        (F.col("vec_id") % anchor_every == 0).alias("anchor"),
    )
    return kept(out, "negatives-rows")


def block_numbers(anchors, rows):
    """Columns n_anchors and n_rows, the blocks needed for these counts of anchors and rows."""
    few, many = CANDIDATES
    n_rows = F.greatest(F.ceil(rows / many), F.least(F.lit(SPREAD), F.ceil(rows / few)), F.lit(1))
    return F.greatest(F.lit(1), F.ceil(anchors / ANCHORS)).cast("long").alias("n_anchors"), n_rows.cast("long").alias("n_rows")


def in_blocks(anchors: DataFrame, rows: DataFrame, keys: Sequence[str]):
    """Anchors and rows grouped by key and pair of blocks: an anchor goes to every block of rows of its key, a row to every block of anchors."""
    every = rows.groupBy(*keys, "anchor").count().groupBy(*keys)
    counts = every.agg(F.coalesce(F.sum(F.when(F.col("anchor"), F.col("count"))), F.lit(0)).alias("__a"), F.coalesce(F.sum("count"), F.lit(0)).alias("__r"))
    if keys:  # keys without an anchor have no positives to find
        blocks = counts.filter("__a > 0").select(*keys, *block_numbers(F.col("__a"), F.col("__r")))
        numbered = [df.join(blocks, list(keys)) for df in (anchors, rows.drop("anchor"))]
    else:
        n = counts.select(*block_numbers(F.col("__a"), F.col("__r"))).first()
        numbered = [df.withColumns({c: F.lit(n[c]).cast("long") for c in n.asDict()}) for df in (anchors, rows.drop("anchor"))]

    def dealt(df: DataFrame, own: str, other: str):
        near = df.withColumn(own, F.pmod(F.xxhash64("a"), F.col(f"n_{own}")))
        near = near.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n_{other}") - 1)))
        near = near.drop("n_anchors", "n_rows")
        # Anchors are rows of the same table: toDF gives each side columns of its own.
        return near.toDF(*near.columns).groupBy(*keys, "anchors", "rows")

    return dealt(numbered[0], "anchors", "rows").cogroup(dealt(numbered[1], "rows", "anchors"))


def hard_negatives(
    embeddings: DataFrame,
    k_positive: int = 5,
    k_negative: int = 5,
    window: tuple[int, int] = (80, 100),
    anchor_every: int = 100,
    shift_every: int = 7,
    labels: int = 10,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``embeddings``: vec_id, embedding, label; other columns are ignored. Rows
    without id or label, without a vector, or with a component that is NULL or
    not finite take no part. An empty vector scores 0 with all; of vectors of
    different lengths the shorter ends in zeros. A repeated row is a row of its
    own wherever candidates are ranked, but none of the anchor's id is its
    positive; a repeated anchor gives its rows once each time. ``window`` is the
    share of the positive's score, in percent, that a negative's must lie in;
    both ends count, and a negative positive score has no window. Vectors longer
    than 2^20 (as given) are an error: their products might not fit.
    """
    rows = prepared(embeddings, anchor_every, shift_every, labels)
    anchors = rows.filter("anchor").drop("anchor")

    def positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return best_positives(left, right, k_positive)

    found = in_blocks(anchors, rows, ["label"]).applyInPandas(positives, POSITIVE)
    first = Window.partitionBy("a").orderBy(F.col("positive_score").desc(), "positive_id")
    best = found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k_positive)
    # At most k_positive of an anchor are left.
    lists = best.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("n", "positive_id", "positive_score"))).alias("positives"))
    asked = kept(anchors.join(lists, "a"), "negatives-positives")

    def negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return best_negatives(left, right, k_negative, *window)

    near = in_blocks(asked, rows, []).applyInPandas(negatives, NEGATIVE)
    order = Window.partitionBy("a", "slot").orderBy(F.col("negative_score").desc(), "negative_id")
    out = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k_negative)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
