"""Benchmark passages in documents, found by spaced seeds and verified around the hits.

A mask looks at some positions of a stretch of tokens and ignores the others, so
a hash under it survives substituted words in the ignored places. The benchmark's
hashes are joined with those of the documents; a bitmap of fixed size built from
them keeps nearly all other document hashes from being shuffled, and lets none
through wrongly for the join is exact. Every joined hit is verified on its own
diagonal: some window of aligned tokens that overlaps the hit must be equal but
for a share of substitutions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

# 1: the token counts, 0: it is ignored. However two of 13 tokens are substituted,
# one of these fits somewhere beside them, so no window of WINDOW tokens is missed.
MASKS = ("11101011", "11001111")
WINDOW = 13  # aligned tokens that are compared, or the whole item if shorter
EQUAL = 0.8  # least share of them that must be equal
LEAST = 5  # an item of fewer tokens is too short to tell and matches nothing
FILTER_BITS = 25  # the bitmap holds 2^25 bits, 4 MB, whatever the benchmark's size
TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased runs of letters and digits."""
    found = TOKEN.findall(text.encode("utf-8", "surrogatepass").lower())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def seed_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash under the mask at every position where it fits."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask) * 1_000_003 + int(mask, 2), np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out = (out ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return out


def filter_slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the bitmap that stand for each hash."""
    low = np.uint64((1 << FILTER_BITS) - 1)
    return (keys & low).astype(np.int64), ((keys >> np.uint64(FILTER_BITS)) & low).astype(np.int64)


def around(h: np.ndarray, at: np.ndarray, reach: int, width: int, edge: int) -> np.ndarray:
    """32-bit tokens from ``reach`` before each position on; ``edge`` stands outside the text."""
    small = np.concatenate([np.full(reach, edge), (h & np.uint64(0x7FFFFFFF)).astype(np.int64), np.full(width, edge)]).astype(np.int32)
    return small[at[:, None] + np.arange(width)]


def short_masks(items: DataFrame) -> list[str]:
    """Plain masks for items shorter than every mask: at most as many as such lengths."""
    sizes = items.filter(F.col("n").between(LEAST, min(map(len, MASKS)) - 1)).select("n").distinct().collect()
    return ["1" * r["n"] for r in sorted(sizes)]


def contaminations(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, equal: float = EQUAL) -> DataFrame:
    """Pairs (doc_id, item_id) with the matched words of the document and their best share of equal ones.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Items shorter
    than ``window`` are compared whole and found if a mask fits beside the
    substitutions; those shorter than every mask are found word for word. Items of the same
    tokens are one item with the smallest id. NULL and empty texts match nothing;
    rows without an id are left out, as they cannot be named. Rows of one id count
    as one document.
    """
    reach = window
    width = reach + max(map(len, MASKS)) + window

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            every = [tokens(x) for x in pdf.text]
            yield pd.DataFrame({"item_id": pdf.item_id, "n": [len(h) for h in every], "tokens": [h.tobytes() for h in every]})

    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.mapInPandas(read, "item_id long, n int, tokens binary").filter(F.col("n") >= LEAST)
    items = kept(items.groupBy("tokens", "n").agg(F.min("item_id").alias("item_id")), "benchmark-items")
    masks = [*MASKS, *short_masks(items)]

    def seeds_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for item, raw in zip(pdf.item_id, pdf.tokens, strict=True):
                h = np.frombuffer(raw, np.uint64)
                # Plain masks serve only items of just their length.
                for mask in [m for m in masks if len(m) <= len(h) and ("0" in m or len(m) == len(h))]:
                    keys = seed_hashes(h, mask)
                    at = np.arange(len(keys))
                    yield pd.DataFrame({"key": keys.view(np.int64), "item_id": item, "item_pos": at, "n": len(h), "own": list(around(h, at, reach, width, -2))})

    seeds = kept(items.mapInPandas(seeds_of, "key long, item_id long, item_pos int, n int, own array<int>"), "benchmark-seeds")
    low = F.lit((1 << FILTER_BITS) - 1).cast("long")
    slot = F.explode(F.array(F.col("key").bitwiseAND(low), F.shiftrightunsigned("key", FILTER_BITS).bitwiseAND(low)))
    words = seeds.select(slot.alias("s")).select(F.shiftright("s", 5).alias("word"), F.expr("shiftleft(1L, cast(s & 31 as int))").alias("bit"))
    # At most 2^20 rows, whatever the benchmark's size.
    filled = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    bitmap[filled["word"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64).astype(np.uint32)

    def hits_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(bitmap.view(np.uint8), bitorder="little").view(bool)
        for pdf in batches:
            for doc, text in zip(pdf.doc_id, pdf.text, strict=True):
                h = tokens(text)
                found: list[tuple[np.ndarray, np.ndarray]] = []
                for mask in masks:
                    keys = seed_hashes(h, mask)
                    first, second = filter_slots(keys)
                    at = np.flatnonzero(bits[first])
                    at = at[bits[second[at]]]
                    if len(at):
                        found.append((keys[at], at))
                if found:
                    keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pd.DataFrame({"key": keys.view(np.int64), "doc_id": doc, "doc_pos": at, "near": list(around(h, at, reach, width, -1))})

    rows = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    hits = rows.mapInPandas(hits_of, "key long, doc_id long, doc_pos int, near array<int>")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            same = np.stack(pdf.near.to_numpy()) == np.stack(pdf.own.to_numpy())
            total = np.concatenate([np.zeros((len(same), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
            n = np.minimum(pdf.n.to_numpy(), window)
            best, where = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
            for size in np.unique(n):
                own = n == size
                # Windows that overlap the hit's first token or follow inside it.
                equal_in = total[own][:, size:] - total[own][:, :-size]
                equal_in[:, : max(0, reach - size + 1)] = 0
                where[own] = equal_in.argmax(axis=1)
                best[own] = equal_in.max(axis=1)
            ok = best >= np.ceil(equal * n - 1e-9)
            first = pdf.doc_pos.to_numpy() - reach + where
            yield pd.DataFrame({"doc_id": pdf.doc_id, "item_id": pdf.item_id, "first_word": first, "last_word": first + n - 1, "share": best / n})[ok]

    joined = hits.join(seeds, "key").select("doc_id", "item_id", "doc_pos", "n", "near", "own")
    sure = joined.mapInPandas(verify, "doc_id long, item_id long, first_word long, last_word long, share double")
    return sure.groupBy("doc_id", "item_id").agg(F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("share").alias("share"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark passage, all their columns.

    Rows are told apart by id and text together: a row without an id is searched
    like any other, and of two texts under one id only the one with a passage goes.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    found = contaminations(keyed.select(F.col("__key").alias("doc_id"), "text"), benchmark)
    return keyed.join(found.select(F.col("doc_id").alias("__key")).distinct(), "__key", "left_anti").select(*docs.columns)
