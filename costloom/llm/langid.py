"""Language of a text by cross-parsing against labelled text of every language.

A suffix automaton of a language's text holds all its substrings. A text is cut
into the longest phrases that occur there, one after the other; the language
that needs the fewest phrases, each counted as log2 of the automaton's text
length and divided by the length of the text, wins. An automaton with its
restarts written in is a table of one entry per state and symbol, so the texts
of a whole batch advance together, one symbol a step, for all languages at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, kept, remainder

UNKNOWN = "und"
SEGMENT = 1024  # symbols that one lane walks
WARM_UP = 64  # symbols before a segment that its first state is guessed from
BLOCK = 1_000_000  # characters of a batch walked together
PARTS = 16  # of a language, ranked apart
MODEL = "lang string, used long, alphabet string, states long, next binary"


def symbols_of(text: str) -> str:
    """Lower-cased letters, with one space for each run of anything else."""
    lowered = text.lower()
    return " ".join("".join(c if c.isalpha() else " " for c in lowered).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the states of the automaton of all substrings; state 0 is the root.

    NUL in ``text`` parts two texts: no substring crosses it.
    """
    nexts: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        if c == "\0":
            last = 0
            continue
        if c in nexts[last]:
            # Only after a part: the substring is known from an earlier text.
            known = nexts[last][c]
            if length[known] == length[last] + 1:
                last = known
                continue
            copy = len(nexts)
            nexts.append(dict(nexts[known]))
            length.append(length[last] + 1)
            link.append(link[known])
            link[known] = copy
            p = last
            while p >= 0 and nexts[p].get(c) == known:
                nexts[p][c] = copy
                p = link[p]
            last = copy
            continue
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            target = nexts[p][c]
            if length[target] == length[p] + 1:
                link[new] = target
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[target]))
                length.append(length[p] + 1)
                link.append(link[target])
                link[target] = link[new] = copy
                while p >= 0 and nexts[p].get(c) == target:
                    nexts[p][c] = copy
                    p = link[p]
        last = new
    return nexts


def parse_table(nexts: list[dict[str, int]], alphabet: str) -> np.ndarray:
    """Per state and symbol: the next state times two, plus one where a phrase starts.

    Symbol 0 is any character outside the alphabet; it is a phrase by itself.
    """
    width = len(alphabet) + 1
    index = {c: i + 1 for i, c in enumerate(alphabet)}
    root = np.ones(width, np.int64)
    for c, s in nexts[0].items():
        root[index[c]] = s * 2 + 1
    out = np.tile(root, (len(nexts), 1))
    for s, row in enumerate(nexts):
        if s:
            for c, t in row.items():
                out[s, index[c]] = t * 2
    return out


class Languages:
    """All languages' tables in one array, over one alphabet."""

    def __init__(self, models: list[tuple[str, int, str, int, bytes]]):
        models = sorted(models)
        self.names = [m[0] for m in models]
        self.bits = np.array([math.log2(max(2, m[1])) for m in models])
        alphabet = sorted(set("".join(m[2] for m in models)) | {" "})
        width = len(alphabet) + 1
        at = {c: i + 1 for i, c in enumerate(alphabet)}
        tables, base = [], 0
        roots = []
        for _, _, own, states, raw in models:
            small = np.frombuffer(raw, np.int32).reshape(states, len(own) + 1).astype(np.int64)
            big = np.empty((states, width), np.int64)
            big[:] = small[:1, :1]  # restart at the root with a phrase of one unknown character
            for i, c in enumerate(own):
                big[:, at[c]] = small[:, i + 1]
            big[:, 0] = small[:, 0]
            tables.append((((big >> 1) * width + base) << 1 | (big & 1)).ravel())
            roots.append(base)
            base += states * width
        self.next = np.concatenate(tables).astype(np.int32 if base < 2**30 else np.int64) if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, self.next.dtype)
        # Symbol of every code point: lower-cased letters, 255 for what is not a letter.
        self.of = np.zeros(0x110000, np.uint16)
        self.at, self.space = at, at[" "]
        self.known = np.zeros(0x110000, bool)

    def encode(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        fresh = np.unique(codes[~self.known[codes]])
        for c in fresh:
            low = chr(c).lower()[:1]
            self.of[c] = self.at.get(low, 0) if low.isalpha() else self.space
            self.known[c] = True
        out = self.of[codes]
        blank = out == self.space
        keep = np.ones(len(out), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        out = out[keep]
        if len(out) and out[0] == self.space:
            out = out[1:]
        if len(out) and out[-1] == self.space:
            out = out[:-1]
        return out

    def _walk(self, symbols, first, length, state, count=None):
        """Advance lanes from ``first`` by ``length`` symbols; lanes are sorted by falling length."""
        state = state.copy()
        if not len(length):
            return state
        steps = int(length[0])
        active = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
        for t in range(steps):
            n = active[t]
            v = self.next[state[:n] + symbols[first[:n] + t][:, None]]
            if count is not None:
                count[:n] += v & 1
            state[:n] = v >> 1
        return state

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of every text in every language."""
        sizes = np.array([len(x) for x in texts], np.int64)
        total = np.zeros((len(texts), len(self.names)), np.int64)
        if not sizes.sum() or not self.names:
            return total
        symbols = np.concatenate(texts).astype(self.next.dtype)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        pieces = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(pieces)[:-1]]), pieces)
        first = starts[doc] + nth * SEGMENT
        length = np.minimum(SEGMENT, sizes[doc] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        doc, nth, first, length = doc[order], nth[order], first[order], length[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        before = np.where(nth > 0, place[np.maximum(order - 1, 0)], -1)  # lane of the segment before
        later = before >= 0
        start = np.tile(self.roots, (len(doc), 1))
        if later.any():
            start[later] = self._walk(symbols, first[later] - WARM_UP, np.full(later.sum(), WARM_UP), start[later])
        counts = np.zeros((len(doc), len(self.names)), np.int64)
        end = self._walk(symbols, first, length, start, counts)
        while True:  # a guess that was wrong is walked again from the true state
            wrong = later & (start != end[before]).any(axis=1)
            if not wrong.any():
                break
            start[wrong] = end[before[wrong]]
            redone = np.zeros((wrong.sum(), len(self.names)), np.int64)
            end[wrong] = self._walk(symbols, first[wrong], length[wrong], start[wrong], redone)
            counts[wrong] = redone
        np.add.at(total, doc, counts)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.names:
            return names, scores
        for lo, hi in blocks([len(x or "") for x in texts], BLOCK):
            coded = [self.encode(x or "") for x in texts[lo:hi]]
            counts = self.phrases(coded) * self.bits
            ranked = np.argsort(counts, axis=1, kind="stable")
            for i, x in enumerate(coded):
                if not len(x):
                    continue
                best = counts[i, ranked[i, 0]]
                names[lo + i] = self.names[ranked[i, 0]]
                second = counts[i, ranked[i, 1]] if len(self.names) > 1 else math.inf
                scores[lo + i] = 1.0 if second == math.inf else float(second / (best + second))
        return names, scores


def fit(docs: DataFrame, text: str, lang: str, rows: int = 300, chars: int = 40_000) -> list[tuple]:
    """Suffix automata of labelled text, one per language.

    The sample is bounded for each language alone: the first ``rows`` different
    texts in the order of a hash, texts of up to 4,000 characters first, and of
    these, in turn, those that still fit into ``chars`` characters; the first
    one always. Texts are taken whole or not at all. They are chosen by hash and
    length, and only the chosen ones are fetched, copies of one text once.
    """
    usable = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    usable = usable.withColumns({"size": F.greatest(F.length("text"), F.lit(4000)), "hash": F.xxhash64("text")})
    # Ranked in parts first: whatever the number of tasks, the last rank sees at most PARTS * rows small rows of a language.
    picked = usable.select("lang", "size", "hash").distinct().withColumn("part", F.pmod("hash", F.lit(PARTS)))
    for within in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*within).orderBy("size", "hash")
        picked = picked.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= rows)
    picked = kept(picked.drop("part"), "langid-picked")
    fetched = usable.join(picked, ["lang", "size", "hash"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    sample = kept(fetched, "langid-sample")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        parts, used = [], 0
        for x in pdf.sort_values("n").text:
            part = symbols_of(x)
            if part and (not used or used + len(part) <= chars):
                parts.append(part)
                used += len(part)
        if not used:
            return pd.DataFrame(columns=["lang", "used", "alphabet", "states", "next"])
        nexts = suffix_automaton("\0".join(parts))
        alphabet = "".join(sorted(set("".join(parts))))
        out = parse_table(nexts, alphabet).astype(np.int32)
        return pd.DataFrame({"lang": [pdf.lang.iloc[0]], "used": [used], "alphabet": [alphabet], "states": [len(nexts)], "next": [out.tobytes()]})

    return [tuple(r) for r in sample.groupBy("lang").applyInPandas(build, MODEL).collect()]


def identify(docs: DataFrame, models: list[tuple], text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score.

    A NULL text, an empty one and one without a letter are ``und`` with score 0,
    as is every text when nothing was learned. The score is the runner-up's cost
    over the sum of both: 0.5 for a tie, which goes to the first name in order.
    Columns of ``docs`` of the same names as the two new ones are replaced.
    """

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages = Languages(models)
        for batch in batches:
            names, scores = languages.predict([x if isinstance(x, str) else None for x in batch])
            yield pd.DataFrame({"lang": names, "score": scores})

    out = docs.withColumn("__lang", predict(F.col(text)))
    return out.withColumns({lang_pred: F.col("__lang.lang"), score: F.col("__lang.score")}).drop("__lang")


def predict_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score: learned where crc32 of the id modulo 3 is not 1.

    A row without an id is learned from and predicted like any other.
    """
    rows = docs.select("doc_id", "text", "lang", (remainder("doc_id", 3) == 1).alias("held_out"))
    models = fit(rows.filter("not held_out"), "text", "lang")
    return identify(rows.select("doc_id", "held_out", "text"), models).select("doc_id", "held_out", "lang_pred", "score")
