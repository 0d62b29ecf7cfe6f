"""Quality as a generalised additive model with pairwise interactions.

A text is measured by a few dozen plain numbers. Each is cut into bins, and
gradient boosting goes round the measures in turn: a shallow tree on one measure
at a time adds to that measure's lookup table, one value a bin. What the tables
leave unexplained picks pairs of measures, whose trees split on both and add to
small two-way tables. A text's log-odds are the intercept and one value of each
table, so scoring a batch is a sum of table look-ups by bin number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, remainder

ROWS = 20_000  # labelled documents the model is fitted on, at most
BINS = 32  # of one measure
PAIR_BINS = 8  # of a measure in a pair
PAIRS = 10
ROUNDS, PAIR_ROUNDS = 300, 100
RATE = 0.1
RIDGE = 5.0  # added to the curvature of a leaf
LEAST = 10  # rows of a leaf

# Classes of characters below 128, by their place in this list; all others count as letters.
SYMBOLS = "#*$%&|<>"
GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n", SYMBOLS, "!?", ".,;:", "'\"()[]{}-_/\\"]
LOWER, UPPER, DIGIT, BLANK, BREAK, SYMBOL, SHOUT, STOP, OTHER = range(len(GROUPS))
CONTROL, BEYOND = len(GROUPS), len(GROUPS) + 1
CLASS = np.full(129, CONTROL, np.int8)
for _n, _chars in enumerate(GROUPS):
    CLASS[[ord(c) for c in _chars]] = _n
CLASS[128] = BEYOND

MEASURES = (
    "chars", "words", "word_mean", "word_spread", "word_longest", "upper", "digits", "symbols", "shouts", "stops",
    "others", "beyond", "blanks", "lines", "line_words", "line_short", "line_repeats", "line_ends", "upper_words", "symbol_words",
    "shout_words", "bare_marks", "distinct", "top_word", "repeats", "runs", "short_words",
)


def measured(text: str) -> list[float]:
    """The measures of a whole text in the order of ``MEASURES``; all zero for one without a word."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(MEASURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = CLASS[np.minimum(codes, 128)]
    share = np.bincount(kind, minlength=BEYOND + 1) / len(codes)
    gap = (kind == BLANK) | (kind == BREAK)
    edge = np.diff(np.concatenate([[1], gap, [1]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sizes = ends - starts

    def words_with(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[ends] - total[starts]

    letters = words_with((kind == LOWER) | (kind == UPPER) | (kind == BEYOND))
    upper = words_with(kind == UPPER)
    symbols, shouts = words_with(kind == SYMBOL), words_with(kind == SHOUT)
    lines = [x for x in text.split("\n") if x.strip()]
    line_words = [x.count(" ") + 1 for x in lines]
    known, known_lines, top, windows = {}, len(set(lines)), 0, 0
    for w in words:
        known[w] = known.get(w, 0) + 1
    top = max(known.values())
    windows = len(set(zip(words, words[1:], words[2:], strict=False)))
    same = np.flatnonzero(np.diff(np.concatenate([[-1], codes.astype(np.int64), [-1]])))
    return [
        np.log1p(len(codes)),
        np.log1p(n),
        sizes.mean(),
        sizes.std(),
        np.log1p(sizes.max()),
        share[UPPER] / max(1e-9, share[UPPER] + share[LOWER] + share[BEYOND]),
        share[DIGIT],
        share[SYMBOL],
        share[SHOUT],
        share[STOP],
        share[OTHER],
        share[BEYOND],
        share[BLANK] + share[BREAK],
        np.log1p(len(lines)),
        np.log1p(n / len(lines)),
        sum(w < 4 for w in line_words) / len(lines),
        1 - known_lines / len(lines),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / len(lines),
        float(((upper >= 2) & (upper == letters)).mean()),
        float(((symbols > 0) & (letters > 0)).mean()),
        float(((shouts > 0) & (letters > 0)).mean()),
        float((letters == 0).mean()),
        len(known) / n,
        top / n,
        1 - windows / max(1, n - 2) if n > 2 else 0.0,
        np.log1p(np.diff(same).max()),
        float((sizes <= 3).mean()),
    ]


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Rising edges that part the values into about equal shares; a value's bin is the number of edges not above it."""
    found = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.zeros(0)
    return found[found > values.min()] if len(found) else found


def split_of(gain_left: np.ndarray, curve_left: np.ndarray, rows_left: np.ndarray) -> tuple[float, int]:
    """(gain, bins on the left) of the best single cut, from sums by bin; 0 bins if none has enough rows."""
    g, h, n = np.cumsum(gain_left), np.cumsum(curve_left), np.cumsum(rows_left)
    left, right = g[:-1] ** 2 / (h[:-1] + RIDGE), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + RIDGE)
    gain = np.where((n[:-1] >= LEAST) & (n[-1] - n[:-1] >= LEAST), left + right - g[-1] ** 2 / (h[-1] + RIDGE), 0.0)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, cuts: int = 2) -> np.ndarray:
    """Values by bin of a tree with up to ``cuts`` cuts, from sums of gradient, curvature and rows by bin."""
    parts = [(0, len(g))]
    for _ in range(cuts):
        found = [(*split_of(g[a:b], h[a:b], n[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(found)
        if not at:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values by cell) of the best tree that cuts one measure, then the other on each side, from sums by cell."""
    best, values = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b, c = (x.T if turned else x for x in (g, h, n))
        whole = a.sum() ** 2 / (b.sum() + RIDGE)
        for cut in range(1, len(a)):
            out, gain = np.zeros_like(a), -whole
            for rows in (slice(0, cut), slice(cut, None)):
                gl, hl, nl = a[rows].sum(0), b[rows].sum(0), c[rows].sum(0)
                if nl.sum() < LEAST:
                    break
                more, at = split_of(gl, hl, nl)
                gain += gl.sum() ** 2 / (hl.sum() + RIDGE) + more
                for cols in (slice(0, at), slice(at, None)) if at else (slice(None),):
                    out[rows, cols] = -gl[cols].sum() / (hl[cols].sum() + RIDGE)
            else:
                if gain > best + 1e-9:
                    best, values = gain, out.T if turned else out
    return best, values


@dataclass
class Additive:
    """Intercept, edges and table of each measure, and for each pair its two measures, their edges and table."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """One look-up a table for every row of ``x`` (rows x measures)."""
        out = np.full(len(x), self.intercept)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edge, x[:, j], side="right")]
        for i, j, first, second, table in self.pairs:
            out += table[np.searchsorted(first, x[:, i], side="right"), np.searchsorted(second, x[:, j], side="right")]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def boosted(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS) -> Additive:
    """The model of measures ``x`` and 0/1 labels ``y``, deterministic. With one class only, or no rows, the score is the class share (0.5 if none)."""
    width = x.shape[1]
    ones = int(y.sum())
    if not 0 < ones < len(y):
        return Additive(0.0 if not len(y) else 30.0 if ones else -30.0, [np.zeros(0)] * width, [np.zeros(1)] * width, [])
    edges = [bin_edges(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    rows = [np.bincount(b, minlength=len(e) + 1) for b, e in zip(bins, edges, strict=True)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    intercept = float(np.log(ones / (len(y) - ones)))
    z = np.full(len(y), intercept)
    for _ in range(rounds):
        for j, b in enumerate(bins):
            if not len(edges[j]):
                continue
            p = 1.0 / (1.0 + np.exp(-z))
            size = len(tables[j])
            step = RATE * tree(np.bincount(b, p - y, size), np.bincount(b, p * (1 - p), size), rows[j])
            tables[j] += step
            z += step[b]
    coarse = [bin_edges(x[:, j], PAIR_BINS) for j in range(width)]
    cell = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def sums(i: int, j: int, w: np.ndarray) -> np.ndarray:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(cell[i] * shape[1] + cell[j], w, shape[0] * shape[1]).reshape(shape)

    p = 1.0 / (1.0 + np.exp(-z))
    one = np.ones(len(y))
    able = [j for j in range(width) if len(coarse[j])]
    ranked = sorted((-pair_tree(sums(i, j, p - y), sums(i, j, p * (1 - p)), sums(i, j, one))[0], i, j) for i, j in combinations(able, 2))
    chosen = [(i, j, sums(i, j, one)) for gain, i, j in ranked[:pairs] if gain < 0]
    grids = [np.zeros_like(n) for _, _, n in chosen]
    for _ in range(pair_rounds):
        for grid, (i, j, n) in zip(grids, chosen, strict=True):
            p = 1.0 / (1.0 + np.exp(-z))
            step = RATE * pair_tree(sums(i, j, p - y), sums(i, j, p * (1 - p)), n)[1]
            grid += step
            z += step[cell[i], cell[j]]
    return Additive(intercept, edges, tables, [(i, j, coarse[i], coarse[j], grid) for grid, (i, j, _) in zip(grids, chosen, strict=True)])


def measure(text):
    """Column of the measures of a text as array<double>; of an empty one for NULL."""

    @F.pandas_udf("array<double>")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([measured(x if isinstance(x, str) else "") for x in batch], dtype=object)

    return look(text)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Additive:
    """Model of ``docs`` (doc_id, text) labelled by ``labels`` (doc_id, quality).

    The sample is bounded: the first ``rows`` labelled documents in the order of a
    hash of the id. It keeps the class shares, so scores mean the same at every
    size. Labels other than 0 and 1 are left out; a document labelled twice is
    good if all its labels say so; of rows that share an id the one with the
    least measures counts. Rows without id or text are not learned from.
    """
    known = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    usable = docs.filter("text is not null").select("doc_id", "text")
    marked = known.join(usable.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = kept(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "quality-labels")
    # At most ``rows`` rows of two numbers, so a broadcast is safe.
    sample = usable.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", measure(F.col("text")).alias("x"))
    found = sample.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).orderBy("doc_id").select("quality", "x").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(MEASURES))
    return boosted(x, found["quality"].to_numpy(float))


def classify(docs: DataFrame, model: Additive, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of being good; a NULL text counts as an empty one, a text is measured whole."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([measured(t if isinstance(t, str) else "") for t in batch]).reshape(len(batch), len(MEASURES))
            yield pd.Series(model.probability(x))

    return docs.withColumn(score, rate(F.col(text)))


def predict_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted; learned where crc32 of the id modulo 3 is not 1.

    A row without an id is scored and never learned from; repeated rows get equal scores.
    """
    train = docs.filter(remainder("doc_id", 3) != 1)
    model = fit(train, labels.select("doc_id", "quality").filter(remainder("doc_id", 3) != 1))
    rows = docs.select("doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out"))
    out = classify(rows, model)
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
