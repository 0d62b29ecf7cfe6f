"""Scores of documents by a causal self-attention model over tokens spelled in subword ids.

Tokens are words and the end of a text. The most frequent words are classes of their own;
every other word goes to the class its subword ids point to. For that each subword has a
profile, the frequent word last seen before it, counted over all training documents; the
profiles of a word's subwords are multiplied and the nearest of the centres taken.
Attention over the tokens before, each entering by its class and the vectors of its subword
ids, gives the probability of a token's class. Inside the
class a known word has its discounted corpus share, and what the discount leaves belongs to unknown
words, spelled by first and later subwords and their number as the class's known words are.
All of it sums to one at most over all texts.

Every training document is cut whole into the windows it would be scored in, so each
of its tokens is a target once a round. Tasks descend on all their windows from common
parameters, which are averaged in Spark after each round.

A text is scored in overlapping windows: each predicts its later part with the
earlier part as context, so that every token is scored once. Windows of many
documents go through masked attention together.

Beside it stands a smoothed unigram score over words. Words above a fixed share
of all tokens, of which there can only be so many, are looked up in the task;
the others are joined with their counts, for both scores.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, kept, remainder

END_WORD = b""  # counts as the end of each document; no word is empty
SHARE = 1_000_000  # a word of at least N / SHARE tokens is looked up in the task: at most SHARE words
PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

OWN = 64  # classes of one word each, the end first
CENTRES = 32  # classes of the other words
CLASSES = OWN + CENTRES
MARKERS = 24  # own words whose nearness makes a subword's profile
PRIOR = 5.0  # tokens the common profile counts for beside a subword's own
CLUSTERED = 100_000  # a word of at least N / CLUSTERED tokens takes part in finding the centres
DISCOUNT = 0.6  # taken from the count of each known word of a centre's class
SPELLED = 200.0  # subwords the common spelling counts for beside a class's own
LENGTHS = 12  # numbers of subwords told apart
WIDTH = 16
WINDOW = 32
CONTEXT = 8  # positions of a window that only give context
STEP = WINDOW - CONTEXT
ROUNDS = 2  # passes over all windows, at every size
BATCH = 64  # windows of one step
BLOCK = 2_000_000  # characters scored together
WRITTEN = 10_000  # training windows handed to Spark together
PLACES = 16  # ids of a word added place by place
CACHED = 400_000  # words a task keeps the ids of


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


class Subwords:
    """Ids of words, each with the space before it, by the ranks of a public vocabulary."""

    def __init__(self, ranks: list[tuple[bytes, int]]):
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
        self.size = max(i for _, i in ranks) + 1
        self.end = self.size  # a free id
        self.opens = np.zeros(self.size + 1, bool)
        for b, i in ranks:
            self.opens[i] = b[:1] == b" "

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, first place of each word, with the end of the last)."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        text = b" " + b" ".join(words)
        try:
            ids = np.asarray(self.encoding.encode_to_numpy(text.decode("utf-8")), np.int64)
            starts = np.flatnonzero(self.opens[ids])
        except UnicodeDecodeError:
            starts = np.zeros(0, np.int64)
        if len(starts) != len(words):  # a word holds a space of another kind, or bytes that are no text
            own = [self.encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]
            ids = np.array([i for o in own for i in o], np.int64)
            starts = np.cumsum([0] + [len(o) for o in own])[:-1]
        return ids, np.append(starts, len(ids))


def vocabulary(spark: SparkSession, path: str) -> list[tuple[bytes, int]]:
    """Ranks of a public vocabulary file; of fixed size, and read by Spark wherever it lies."""
    rows = spark.read.text(path).filter("value <> ''").collect()
    return [(base64.b64decode(a), int(b)) for a, b in (r["value"].split() for r in rows)]


def nonzero(table: np.ndarray) -> pd.DataFrame:
    """The numbers of a table other than 0 as rows."""
    own = np.flatnonzero(table)
    return pd.DataFrame({"key": own, "n": table[own]})


def summed(df: DataFrame, size: int) -> np.ndarray:
    """Rows (key, n) added up to a table of fixed size."""
    rows = df.groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["key"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def parts(ids: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of the chosen words in turn, place of each in its word, how many each word has)."""
    size = at[chosen + 1] - at[chosen]
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return ids[np.repeat(at[chosen], size) + place], place, size


class Classes:
    """Class of a word by its subword ids, from the subwords' profiles."""

    def __init__(self, own: list[bytes], profile: np.ndarray):
        self.own = {w: i for i, w in enumerate(own)}
        common = profile.sum(0) + 1.0
        common /= common.sum()
        self.ratio = np.log((profile + PRIOR * common) / (profile.sum(1, keepdims=True) + PRIOR) / common).astype(np.float32)
        self.common = np.log(common).astype(np.float32)
        self.centres = np.zeros((CENTRES, profile.shape[1]), np.float32)

    def vectors(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Roots of the words' joint profiles; ``at`` holds the first place of each word and the end."""
        t = np.add.reduceat(self.ratio[ids], at[:-1], axis=0) + self.common
        t = np.exp(t - t.max(1, keepdims=True))
        return np.sqrt(t / t.sum(1, keepdims=True))

    def of(self, words: list[bytes], ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Class of each word; the words are not empty."""
        out = np.empty(len(words), np.int64)
        for lo in range(0, len(words), 50_000):
            part = at[lo : lo + 50_001]
            x = self.vectors(ids[part[0] : part[-1]], part - part[0])
            out[lo : lo + 50_000] = OWN + nearest(x, self.centres)
        known = self.own.get
        for i, w in enumerate(words):
            c = known(w)
            if c is not None:
                out[i] = c
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)


def centres_of(x: np.ndarray, weight: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Weighted k-means from far, heavy points; the same for the same input."""
    if not len(x):
        return np.zeros((CENTRES, x.shape[1]), np.float32)
    found = [np.average(x, axis=0, weights=weight)]
    far = np.full(len(x), np.inf)
    for _ in range(CENTRES - 1):
        far = np.minimum(far, ((x - found[-1]) ** 2).sum(1))
        found.append(x[np.argmax(far * np.sqrt(weight))])
    centres = np.array(found, np.float32)
    for _ in range(rounds):
        g = nearest(x, centres)
        total = np.bincount(g, weight, CENTRES)
        for m in range(x.shape[1]):
            s = np.bincount(g, weight * x[:, m], CENTRES)
            centres[total > 0, m] = s[total > 0] / total[total > 0]
    return centres


def joined(table: np.ndarray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mean vector of each word's subword ids; ``size`` tells how many ids of the turn each word has, none giving zeros.

    Words go by their number of ids, most first, so that those with a further id are the first ones; ids
    from ``PLACES`` on, of which few words have any, are added apart.
    """
    order = np.argsort(-np.minimum(size, PLACES + 1).astype(np.int16), kind="stable")
    at, size = (np.cumsum(size) - size)[order], size[order]
    total = np.zeros((len(size), table.shape[1]), np.float32)
    having = len(size) - np.cumsum(np.bincount(np.minimum(size, PLACES + 1), minlength=PLACES + 2))  # words of more than j ids
    for j, n in enumerate(having[:PLACES].tolist()):
        if not n:
            break
        total[:n] += table.take(ids.take(at[:n] + j), axis=0)
    if n := int(having[PLACES]):
        more = size[:n] - PLACES
        first = np.cumsum(more) - more
        total[:n] += np.add.reduceat(table[ids[np.repeat(at[:n] + PLACES - first, more) + np.arange(more.sum())]], first, axis=0)
    total /= np.maximum(size, 1).astype(np.float32)[:, None]
    out = np.empty_like(total)
    out[order] = total
    return out


class Spelling:
    """What is known of the words of each class: tokens, discounted rest, and the log10 of a spelling."""

    def __init__(self, table: np.ndarray, size: int):
        cut = np.cumsum([CLASSES, CLASSES, CENTRES * size, CENTRES * size])
        self.tokens, words, first, later, lengths = np.split(table, cut)
        self.rest = np.log10(DISCOUNT * words + 1.0)  # of the class's tokens and one more
        self.whole = np.log10(self.tokens + 1.0)
        self.whole[:OWN] = 0.0  # a word of its own class is certain there
        self.places = [self.shares(t.reshape(CENTRES, size)) for t in (first, later)]
        lengths = lengths.reshape(CENTRES, LENGTHS) + 1.0
        self.lengths = np.log10(lengths / lengths.sum(1, keepdims=True))

    @staticmethod
    def shares(t: np.ndarray) -> np.ndarray:
        common = t.sum(0) + 0.01
        common /= common.sum()
        return np.log10((t + SPELLED * common) / (t.sum(1, keepdims=True) + SPELLED)).astype(np.float32)

    @staticmethod
    def size(size: int) -> int:
        return 2 * CLASSES + 2 * CENTRES * size + CENTRES * LENGTHS

    @staticmethod
    def counted(group: np.ndarray, n: np.ndarray, ids: np.ndarray, at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places in the table, amounts) for words of these classes and counts."""
        far = np.flatnonzero(group >= OWN)
        seq, place, length = parts(ids, at, far)
        k = group[far] - OWN
        cell = 2 * CLASSES + np.where(place == 0, 0, CENTRES * size) + np.repeat(k, length) * size + seq
        by_length = 2 * CLASSES + 2 * CENTRES * size + k * LENGTHS + np.minimum(length, LENGTHS) - 1
        places = np.concatenate([CLASSES + group, cell, by_length])
        return [(group, n), (places, np.ones(len(places), np.int64))]

    def unknown(self, group: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 of rest and spelling of each word, were it unknown; the class's tokens still to be divided by."""
        out = np.zeros(len(group))
        far = np.flatnonzero(group >= OWN)
        seq, place, length = parts(ids, at, far)
        k = np.repeat(group[far] - OWN, length)
        logs = np.where(place == 0, self.places[0][k, seq], self.places[1][k, seq]).astype(float)
        word = np.repeat(np.arange(len(far)), length)
        k = group[far] - OWN
        # Numbers of subwords from LENGTHS on halve with each further one.
        more = np.maximum(0, length - LENGTHS + 1) * math.log10(0.5)
        out[far] = np.bincount(word, logs, len(far)) + self.lengths[k, np.minimum(length, LENGTHS) - 1] + more + self.rest[group[far]]
        return out


SHAPES = {"e": (CLASSES + 1, WIDTH), "p": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "u": (WIDTH, CLASSES), "b": (CLASSES,)}
START = CLASSES  # input class before the first token


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def first_parameters(class_counts: np.ndarray, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.3 if n in "eu" else 0.1 if n == "p" else 0.25, s) for n, s in SHAPES.items()]
    parts[-1] = np.log((class_counts + 1.0) / (class_counts + 1.0).sum())
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


def gradient(m: dict[str, np.ndarray], c: np.ndarray, y: np.ndarray, real: np.ndarray, own: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Mean loss over the real positions and its gradient, flat; ``c`` inputs, ``y`` targets (windows x positions).

    ``own``, a vector a position from its subword ids, is added to the input and replaced by its slope.
    Class scores are computed where a target counts only. Ones beside the input, the value and the
    output sum the attention and add the bias; both softmaxes stay unnormalised, their sums going into narrow arrays.
    """
    dtype, count, n = m["e"].dtype, c.shape, c.size
    scale = dtype.type(1 / math.sqrt(WIDTH))
    x = np.empty((n, WIDTH + 1), dtype)
    x[:, WIDTH] = 1
    given = m["e"].take(c.ravel(), axis=0)
    given.reshape(*count, WIDTH)[...] += m["p"]
    if own is not None:
        given += own
    x[:, :WIDTH] = given
    mixed = np.zeros((WIDTH + 1, 3 * WIDTH + 1), dtype)
    mixed[:WIDTH, : 3 * WIDTH] = np.hstack([m["q"] * scale, m["k"], m["v"]])
    mixed[WIDTH, 3 * WIDTH] = 1
    qkv = (x @ mixed).reshape(*count, 3 * WIDTH + 1)
    q, k, v = qkv[..., :WIDTH], qkv[..., WIDTH : 2 * WIDTH], qkv[..., 2 * WIDTH :]
    a = q @ k.transpose(0, 2, 1)
    a += MASK
    if a.max() > 60:  # exp stays finite
        a -= a.max(-1, keepdims=True)
    np.exp(a, out=a)
    o = (a @ v).reshape(n, WIDTH + 1)
    over = 1 / o[:, WIDTH:]
    o = o[:, :WIDTH] * over
    h = x.copy()
    h[:, :WIDTH] += o @ m["o"]
    chosen = np.flatnonzero(real)
    h = h.take(chosen, axis=0)
    u = np.vstack([m["u"], m["b"]])
    p = h @ u
    at, aim = np.arange(len(p)), y.ravel()[chosen]
    if len(p) and p.max() > 60:
        p -= p.max(-1, keepdims=True)
    hit = p[at, aim]
    np.exp(p, out=p)
    total = p @ np.ones(p.shape[1], dtype)
    share = dtype.type(1 / max(1, len(p)))
    loss = float(((np.log(total) - hit) * share).sum())
    p[at, aim] -= total
    part = (share / total)[:, None]  # times this, the slope by the class scores
    dh = np.zeros((n, WIDTH), dtype)
    dh[chosen] = (p @ m["u"].T) * part
    h *= part
    du = (p.T @ h).T
    do = np.empty((n, WIDTH + 1), dtype)
    np.matmul(dh, m["o"].T, out=do[:, :WIDTH])
    do[:, :WIDTH] *= over
    np.einsum("ij,ij->i", do[:, :WIDTH], o, out=do[:, WIDTH])
    np.negative(do[:, WIDTH], out=do[:, WIDTH])
    do = do.reshape(*count, WIDTH + 1)
    d = np.empty((*count, 3 * WIDTH), dtype)
    ds = do @ v.transpose(0, 2, 1)
    ds *= a
    np.matmul(ds, k, out=d[..., :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=d[..., WIDTH : 2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), do[..., :WIDTH], out=d[..., 2 * WIDTH :])
    d = d.reshape(n, 3 * WIDTH)
    dx = d @ mixed[:WIDTH, : 3 * WIDTH].T
    dx += dh
    if own is not None:
        own[:] = dx
    dm = (d.T @ x).T
    grads = {
        "e": np.bincount(((c.ravel() * WIDTH)[:, None] + np.arange(WIDTH)).ravel(), dx.ravel(), m["e"].size),
        "p": np.ones(count[0], dtype) @ dx.reshape(count[0], -1),
        "q": dm[:WIDTH, :WIDTH] * scale,
        "k": dm[:WIDTH, WIDTH : 2 * WIDTH],
        "v": dm[:WIDTH, 2 * WIDTH :],
        "o": o.T @ dh,
        "u": du[:WIDTH],
        "b": du[WIDTH],
    }
    return loss, np.concatenate([grads[n].ravel() for n in SHAPES]).astype(np.float32)


def binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of bytes: numbers in turn, cut after each of ``ends``."""
    at = np.concatenate([[0], ends * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def numbers_of(column: pa.Array, dtype: type) -> np.ndarray:
    """The numbers of all rows of bytes in turn."""
    _, at, values = column.buffers()
    at = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(values, np.uint8)[at[0] : at[-1]].view(dtype) if at[-1] > at[0] else np.zeros(0, dtype)


def trained(windows: np.ndarray) -> np.ndarray:
    """Which targets count: those of the text, but where a window only repeats the one before for context."""
    real = windows[:, 1:] >= 0
    real[windows[:, 0] != START, :CONTEXT] = False
    return real


class Spelled:
    """Subword ids of the inputs of windows, in turn, and how many each input has (windows x positions)."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        self.ids, self.size = ids, size
        self.at = np.concatenate([[0], np.cumsum(size.sum(1))])

    def of(self, chosen: np.ndarray) -> "Spelled":
        return Spelled(parts(self.ids, self.at, chosen)[0], self.size[chosen])

    def cut(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these windows in turn, how many each input has)."""
        return self.ids[self.at[lo] : self.at[hi]], self.size[lo:hi].ravel()


class Adam:
    """Steps on windows as they come; the rate falls from ``rate`` with the number of steps.

    ``table`` holds a vector for each subword id; a step moves those of the ids it meets.
    """

    def __init__(self, flat: np.ndarray, rate: float, table: np.ndarray | None = None):
        self.flat, self.rate, self.t = flat.copy(), rate, 0
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)
        self.spelled = None
        if table is not None:
            self.table, self.table_m, self.table_v = table.copy(), np.zeros_like(table), np.zeros_like(table)
            self.seen, self.number = np.zeros(len(table), bool), np.zeros(len(table), np.int64)

    def epoch(self, windows: np.ndarray, seed: int, spelled: Spelled | None = None) -> None:
        order = np.random.default_rng(seed).permutation(len(windows))
        windows = windows[order]
        if spelled is not None:
            spelled = spelled.of(order)
        for i in range(0, len(windows), BATCH):
            self.spelled = None if spelled is None else spelled.cut(i, min(i + BATCH, len(windows)))
            self.step(windows[i : i + BATCH])

    def step(self, windows: np.ndarray) -> float:
        c, y = windows[:, :-1], windows[:, 1:]
        own = None
        if self.spelled is not None:
            ids, length = self.spelled
            self.seen[ids] = True
            met = np.flatnonzero(self.seen)
            self.seen[met] = False
            self.number[met] = np.arange(len(met))
            which, vectors = self.number.take(ids), self.table.take(met, axis=0)
            own = joined(vectors, which, length)
        loss, g = gradient(unpacked(self.flat), np.maximum(c, 0), np.maximum(y, 0), trained(windows), own)
        self.t += 1
        size = self.rate / (1 + self.t / 400) ** 0.5
        first, second = 1 - 0.9**self.t, 1 - 0.99**self.t
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.99 * self.v + 0.01 * g * g
        self.flat = self.flat - size * (self.m / first) / (np.sqrt(self.v / second) + 1e-8)
        if own is not None and len(ids):
            own /= np.maximum(length, 1).astype(np.float32)[:, None]
            slope = own.take(np.repeat(np.arange(len(length)), length), axis=0)
            g = np.zeros(len(met) * WIDTH, np.float32)
            np.add.at(g, ((which * WIDTH)[:, None] + np.arange(WIDTH)).ravel(), slope.ravel())
            g = g.reshape(-1, WIDTH)
            m, v = self.table_m.take(met, axis=0), self.table_v.take(met, axis=0)
            m *= 0.9
            m += 0.1 * g
            g *= g
            v *= 0.99
            g *= 0.01
            v += g
            self.table_m[met], self.table_v[met] = m, v
            v /= second
            np.sqrt(v, out=v)
            v += 1e-8
            m *= size / first
            m /= v
            vectors -= m
            self.table[met] = vectors
        return loss


def window_places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each window, its number in the text, first and end place of each text); first windows come first."""
    ends = np.cumsum(sizes)
    later = np.maximum(0, -(-(sizes - WINDOW) // STEP))  # windows after a text's first
    doc = np.concatenate([np.arange(len(sizes)), np.repeat(np.arange(len(sizes)), later)])
    nth = np.concatenate([np.zeros(len(sizes), np.int64), np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later) + 1])
    real = sizes[doc] > 0
    return doc[real], nth[real], ends - sizes, ends


class Scorer:
    """Tables of the trained model, ready for many windows.

    One row per class, and one per position to be added, holds the query, the key,
    the value (through the output matrix) with a 1 that sums the attention, and
    the input with a 1 for the bias.
    """

    def __init__(self, flat: np.ndarray):
        m = unpacked(flat.astype(np.float32))
        scale = np.float32(1 / math.sqrt(WIDTH))

        def row(x: np.ndarray, one: float) -> np.ndarray:
            ones = np.full((len(x), 1), one, np.float32)
            return np.hstack([x @ m["q"] * scale, x @ m["k"], x @ m["v"] @ m["o"], ones, x, ones]).astype(np.float32)

        self.classes, self.places = row(m["e"], 1.0), row(m["p"], 0.0)
        self.u = np.vstack([m["u"], m["b"]]).astype(np.float32)
        self.ones = np.ones(CLASSES, np.float32)
        self.added = row(np.eye(WIDTH, dtype=np.float32), 0.0)  # of an input vector from subword ids

    def log10(self, t: np.ndarray, y: np.ndarray, first: int) -> np.ndarray:
        """log10 probability of the targets from position ``first`` on (windows x positions); ``t`` holds the inputs' rows."""
        s = t[:, first:, :WIDTH] @ t[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1)
        s += MASK[first:]
        if s.max() > 60:  # exp stays finite
            s -= s.max(-1, keepdims=True)
        np.exp(s, out=s)
        o = s @ t[:, :, 2 * WIDTH : 3 * WIDTH + 1]
        h = t[:, first:, 3 * WIDTH + 1 :].copy()
        h[:, :, :WIDTH] += o[:, :, :WIDTH] / o[:, :, WIDTH:]
        z = h.reshape(-1, WIDTH + 1) @ self.u
        if z.max() > 60:
            z -= z.max(-1, keepdims=True)
        hit = z[np.arange(len(z)), y[:, first:].ravel()].astype(np.float64)
        np.exp(z, out=z)
        return ((hit - np.log((z @ self.ones).astype(np.float64))) / math.log(10)).reshape(len(t), -1)

    def scores(self, classes: np.ndarray, sizes: np.ndarray, number: np.ndarray | None = None, vectors: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of each document's classes; ``classes`` holds all of them in turn.

        ``number`` holds the words in turn and ``vectors`` what each word's subword ids add to its input.
        The row of an input is made once for all places of its word.
        """
        total = np.zeros(len(sizes))
        if not len(classes):
            return total
        if vectors is None:
            rows, turn = self.classes, classes.astype(np.int64)
        else:
            met, turn = np.unique(number * CLASSES + classes, return_inverse=True)
            rows = self.classes[met % CLASSES] + vectors[met // CLASSES] @ self.added
            rows = np.concatenate([rows, self.classes[START:]])
        start = len(rows) - 1  # the row of the input before the first token
        doc, nth, starts, ends = window_places(sizes)
        padded = np.concatenate([classes, np.zeros(WINDOW + 1, classes.dtype)])
        turn = np.concatenate([turn, np.full(WINDOW + 1, start)])
        place = starts[doc] + nth * STEP
        grid = np.arange(WINDOW)
        n_first = int((nth == 0).sum())
        for lo, hi, skip in [(i, min(i + 128, n_first), 0) for i in range(0, n_first, 128)] + [(i, min(i + 128, len(doc)), CONTEXT) for i in range(n_first, len(doc), 128)]:
            index = place[lo:hi, None] + grid
            y = padded.take(index)
            c = turn.take(index - 1, mode="wrap")
            if not skip:
                c[:, 0] = start
            t = rows.take(c, axis=0)
            t += self.places
            p = self.log10(t, y, skip)
            inside = index[:, skip:] < ends[doc[lo:hi], None]
            total += np.bincount(doc[lo:hi], (p * inside).sum(1), len(total))
        return total


def word_counts(train: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts: lower-cased words as bytes, and the end of each text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: Counter[bytes] = Counter()
        for pdf in batches:
            for x in pdf[text]:
                own.update(words_of(x) if isinstance(x, str) else ())
            own[END_WORD] += len(pdf)
            if len(own) > 300_000:
                yield pd.DataFrame({"word": list(own.keys()), "n": list(own.values())})
                own = Counter()
        if own:
            yield pd.DataFrame({"word": list(own.keys()), "n": list(own.values())})

    return train.select(text).mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class WordIds:
    """Subword ids, classes and looked-up counts of the words a task has met, up to ``CACHED`` words at a time."""

    def __init__(self, subwords: Subwords, known: dict[bytes, int], classes: Classes | None = None, spelling: Spelling | None = None, table: np.ndarray | None = None):
        self.subwords, self.known, self.classes, self.spelling, self.table = subwords, known, classes, spelling, table
        self.forget()

    def forget(self) -> None:
        self.index = Numbers({END_WORD: 0})
        self.ids, self.at = np.array([self.subwords.end]), np.array([0, 1])
        self.count = np.array([self.known.get(END_WORD, -1)])
        self.group, self.unknown, self.vectors = np.zeros(1, np.int64), np.zeros(1), np.zeros((1, WIDTH), np.float32)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all words in turn with an end after each text, how many each text has)."""
        if len(self.index) > CACHED:
            self.forget()
        before = len(self.index)
        out, sizes = [], []
        for x in texts:
            own = list(map(self.index.__getitem__, words_of(x)))
            own.append(0)
            out.append(np.array(own, np.int64))
            sizes.append(len(own))
        new = list(islice(self.index, before, None))
        if new:
            ids, at = self.subwords.encode(new)
            self.at = np.concatenate([self.at, at[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
            self.count = np.concatenate([self.count, [self.known.get(w, -1) for w in new]])
            if self.classes:
                group = self.classes.of(new, ids, at)
                self.group = np.concatenate([self.group, group])
                if self.spelling:
                    self.unknown = np.concatenate([self.unknown, self.spelling.unknown(group, ids, at)])
            if self.table is not None:
                self.vectors = np.concatenate([self.vectors, joined(self.table, ids, np.diff(at))])
        return np.concatenate(out), np.array(sizes, np.int64)


def texts_of(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce("text", F.lit("")).alias("text"))


def profiles(train: DataFrame, ranks: list[tuple[bytes, int]], own: list[bytes]) -> np.ndarray:
    """How often each subword stands behind each marker, the marker last seen in its text; the end stands for none."""
    marker = {w: i for i, w in enumerate(own[:MARKERS])}
    size = max(i for _, i in ranks) + 2

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordIds(Subwords(ranks), marker)
        total = np.zeros(size * MARKERS, np.int64)
        for pdf in batches:
            for lo, hi in blocks([len(x) for x in pdf.text], BLOCK):
                number, _ = words.numbers(list(pdf.text[lo:hi]))
                mark = words.count[number]
                last = np.maximum.accumulate(np.where(mark >= 0, np.arange(len(mark)), -1))
                last = np.append(-1, last[:-1])
                behind = np.where(last >= 0, mark[np.maximum(last, 0)], 0)
                pair, times = np.unique(number * MARKERS + behind, return_counts=True)
                ids, _, length = parts(words.ids, words.at, pair // MARKERS)
                np.add.at(total, ids * MARKERS + np.repeat(pair % MARKERS, length), np.repeat(times, length))
        yield nonzero(total)

    return summed(texts_of(train).mapInPandas(count, "key long, n long"), size * MARKERS).reshape(size, MARKERS)


def spelling_of(counts: DataFrame, ranks: list[tuple[bytes, int]], classes: Classes) -> Spelling:
    """The words of each class and their spellings, from the counts of all words."""
    size = max(i for _, i in ranks) + 2

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        subwords, total = Subwords(ranks), np.zeros(Spelling.size(size), np.int64)
        for pdf in batches:
            text = [bytes(w) for w in pdf.word]
            n = pdf.n.to_numpy()
            end = np.array([w == END_WORD for w in text], bool)
            total[0] += n[end].sum()
            text = [w for w in text if w]
            if text:
                ids, at = subwords.encode(text)
                for cell, amount in Spelling.counted(classes.of(text, ids, at), n[~end], ids, at, size):
                    np.add.at(total, cell, amount)
        yield nonzero(total)

    return Spelling(summed(counts.mapInPandas(count, "key long, n long"), Spelling.size(size)), size)


def training_windows(train: DataFrame, ranks: list[tuple[bytes, int]], classes: Classes) -> DataFrame:
    """All windows of all texts, as they enter and as they are predicted.

    ``w``: classes, WINDOW + 1 each: the input before the first, then targets; -1 past the text.
    ``ids``: the subword ids of the inputs in turn, and ``size``: how many each input has.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(Subwords(ranks), {}, classes)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in blocks([len(x) for x in texts], BLOCK):
                number, sizes = words.numbers(texts[lo:hi])
                c = words.group[number]
                doc, nth, starts, ends = window_places(sizes)
                for i in range(0, len(doc), WRITTEN):
                    own, n = doc[i : i + WRITTEN], nth[i : i + WRITTEN]
                    index = (starts[own] + n * STEP)[:, None] + np.arange(-1, WINDOW)
                    rows = np.where(index < ends[own, None], c[np.clip(index, 0, len(c) - 1)], -1).astype(np.int16)
                    rows[n == 0, 0] = START
                    given = (rows[:, 1:] >= 0) & (rows[:, :-1] != START)
                    ids, _, length = parts(words.ids, words.at, number[index[:, :-1][given]])
                    size = np.zeros(given.shape, np.int32)
                    size[given] = length
                    grid = np.arange(1, len(rows) + 1)
                    columns = [binary(rows, grid * rows.shape[1]), binary(ids.astype(np.int32), np.cumsum(size.sum(1))), binary(size, grid * WINDOW)]
                    yield pa.RecordBatch.from_arrays(columns, ["w", "ids", "size"])

    return kept(texts_of(train).mapInArrow(cut, "w binary, ids binary, size binary"), "lm-windows", "zstd")


def train_model(windows: DataFrame, flat: np.ndarray, rounds: int = ROUNDS, size: int = 0) -> tuple[np.ndarray, np.ndarray | None]:
    """Parameters and the vectors of ``size`` subword ids after rounds of local descent in every task and averaging over tasks.

    A round is one pass over all windows. A task returns what it changed, as rows of
    WIDTH numbers: the parameters and the vectors of the ids it met.
    """
    table = np.zeros((size, WIDTH), np.float32) if size else None
    pad = -len(flat) % WIDTH
    own_rows = (len(flat) + pad) // WIDTH
    numbers = [f"x{j}" for j in range(WIDTH)]
    for r in range(rounds):
        rate = 0.01 / (1 + r)

        def descend(batches: Iterator[pa.RecordBatch], flat: np.ndarray = flat, table: np.ndarray | None = table, rate: float = rate) -> Iterator[pa.RecordBatch]:
            adam, rows = Adam(flat, rate, table), 0
            for batch in batches:
                w = numbers_of(batch.column("w"), np.int16).reshape(batch.num_rows, -1).astype(np.int64)
                spelled = None
                if table is not None:
                    size = numbers_of(batch.column("size"), np.int32).reshape(batch.num_rows, -1)
                    spelled = Spelled(numbers_of(batch.column("ids"), np.int32).astype(np.int64), size.astype(np.int64))
                adam.epoch(w, len(w), spelled)
                rows += len(w)
            if rows:
                moved = np.pad(adam.flat.astype(float) - flat, (0, pad)).reshape(-1, WIDTH)
                met = np.zeros(0, np.int64) if table is None else np.flatnonzero((adam.table != table).any(1))
                if len(met):
                    moved = np.concatenate([moved, adam.table[met].astype(float) - table[met]])
                moved *= rows
                columns = [np.concatenate([np.arange(own_rows), own_rows + met]), *(np.ascontiguousarray(x) for x in moved.T), np.full(len(moved), float(rows))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["i", *numbers, "n"])

        schema = "i long, " + ", ".join(f"{x} double" for x in numbers) + ", n double"
        found = windows.mapInArrow(descend, schema).groupBy("i").agg(*[F.sum(x).alias(x) for x in (*numbers, "n")]).toPandas().sort_values("i")
        if len(found):
            # An id that a task did not meet has not moved there.
            moved = found[numbers].to_numpy() / found["n"].to_numpy()[0]
            flat = (flat + moved[:own_rows].ravel()[: len(flat)]).astype(np.float32)
            if table is not None:
                table = table.copy()
                table[found["i"].to_numpy()[own_rows:] - own_rows] += moved[own_rows:].astype(np.float32)
    return flat, table


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_log double, score double, tail array<struct<word:binary,n:int,unknown:double>>"


def scores(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row of ``docs``.

    Documents whose crc32(doc_id) modulo 10 is 0 are held out of every count and
    of training. A NULL text is an empty one: its only token is the end. A row
    without an id is learned from. Without training documents the base is 0 and
    the model stays at its start.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (remainder("doc_id", 10) == 0).alias("held_out"))
    train = rows.filter("not held_out")
    ranks = vocabulary(spark, vocabulary_path)
    counts = kept(word_counts(train), "lm-words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    often = counts.filter(F.col("word") != F.lit(END_WORD)).orderBy(F.desc("n"), "word").limit(OWN - 1).collect()
    classes = Classes([END_WORD, *(bytes(r["word"]) for r in often)], profiles(train, ranks, [END_WORD, *(bytes(r["word"]) for r in often)]))
    heavy = counts.filter((F.col("word") != F.lit(END_WORD)) & (F.col("n") * CLUSTERED >= total)).orderBy("word").toPandas()
    if len(heavy):
        classes.centres = centres_of(classes.vectors(*Subwords(ranks).encode([bytes(w) for w in heavy["word"]])), heavy["n"].to_numpy(float))
    spelling = spelling_of(counts, ranks, classes)
    flat, table = train_model(training_windows(train, ranks, classes), first_parameters(spelling.tokens), size=max(i for _, i in ranks) + 2)
    # At most SHARE words can have so large a part of the tokens.
    head = counts.filter(F.col("n") * SHARE >= total).toPandas()
    head_words, head_counts = [bytes(w) for w in head["word"]], head["n"].to_numpy(np.int64)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordIds(Subwords(ranks), dict(zip(head_words, head_counts.tolist(), strict=True)), classes, spelling, table)
        scorer = Scorer(flat)
        for pdf in batches:
            for lo, hi in blocks([len(x) for x in pdf.text], BLOCK):
                own = pdf.iloc[lo:hi]
                number, sizes = words.numbers(list(own.text))
                text_of = np.repeat(np.arange(len(own)), sizes)
                c, group = words.count[number], words.group[number]
                in_head = c >= 0
                logs = np.bincount(text_of[in_head], np.log10(c[in_head] + 0.1), len(own))
                hits = np.bincount(text_of[in_head], minlength=len(own))
                model = scorer.scores(group, sizes, number, words.vectors) - np.bincount(text_of, spelling.whole[group], len(own))
                shared = in_head & (group >= OWN)
                model += np.bincount(text_of[shared], np.log10(c[shared] - DISCOUNT), len(own))
                spread = len(words.index)
                key, times = np.unique(text_of[~in_head] * spread + number[~in_head], return_counts=True)
                names = list(words.index)
                tails: list[list[dict]] = [[] for _ in range(len(own))]
                for i, k, n, u in zip((key // spread).tolist(), (key % spread).tolist(), times.tolist(), words.unknown[key % spread].tolist(), strict=True):
                    tails[i].append({"word": names[k], "n": n, "unknown": u})
                yield pd.DataFrame({"row": own.row, "doc_id": own.doc_id, "held_out": own.held_out, "n_tokens": sizes, "head_known": hits, "head_log": logs, "score": model, "tail": tails})

    texts = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text"))
    scored = kept(texts.mapInPandas(score, SCORED), "lm-scored", "zstd")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("times"), F.col("t.unknown").alias("unknown"))
    found = tail.join(counts, "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    # A word of its own class is certain there, whether looked up or joined.
    inside = F.when(F.col("unknown") == 0, 0.0).when(F.col("c") > 0, F.log10(F.col("c") - DISCOUNT)).otherwise(F.col("unknown"))
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 0.1)).alias("tail_log"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"), F.sum(F.col("times") * inside).alias("tail_score"))
    scale = F.lit(math.log10(total + 0.1 * (distinct + 1)))
    out = scored.drop("tail").join(sums, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
    )
