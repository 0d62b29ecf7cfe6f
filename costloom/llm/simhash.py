"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are laid out once per root node. A root's mask selects
``choose`` of ``distance + choose`` blocks of bits: two fingerprints that differ
in at most ``distance`` bits agree on at least one mask. The masked bits are
moved to the front and the fingerprints range-partitioned by the Gray rank of
the result, so those that share a root's pattern lie side by side, and a crowded
pattern is spread over as many tasks as it needs.

In a task the sorted fingerprints become a tree. A node holds the bits all its
members share (mask and pattern); two nodes whose shared bits differ in more than
``distance`` places are pruned with everything below. Links that survive are
united at once and only a spanning forest leaves the task, so a crowd of near
copies never becomes all its pairs. Patterns that lie across tasks are compared
once more, pair by pair of their parts. The forests' components are found by
large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

SEED = 42
BITS = 64
LEAF = 64  # fingerprints of a lowest node
FANOUT = 8
FRONTIER = 200_000  # pairs of nodes held at once
SMALL = 16  # up to so many fingerprints are compared without a tree
PART_ROWS = 400_000  # rows of the index in one task


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of the words' shingles as an unsigned number; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    start = end - size
    h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(start[: n - shingle + 1].tolist(), end[shingle - 1 :].tolist(), strict=True)), np.uint64, n - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 8192):
        ones += np.unpackbits(h[i : i + 8192, None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long; a NULL text has none of the words, so 0."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [fingerprint(x, shingle) if isinstance(x, str) else 0 for x in batch]
            yield pd.Series(np.array(found, np.uint64).view(np.int64))

    return docs.withColumn(name, run(F.col(text)))


def roots(distance: int, choose: int) -> list[list[tuple[int, int]]]:
    """Per root node its blocks (first bit, bits): the chosen blocks first, then the others."""
    edges = np.linspace(0, BITS, distance + choose + 1).round().astype(int)
    cuts = [(int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [[cuts[i] for i in own] + [c for i, c in enumerate(cuts) if i not in own] for own in combinations(range(len(cuts)), choose)]


def moved(fp: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """Fingerprints with their blocks in the given order, the first one on top."""
    out = np.zeros_like(fp)
    for first, n in order:
        out = (out << np.uint64(n)) | ((fp >> np.uint64(first)) & np.uint64((1 << n) - 1))
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class Forest:
    """Union of elements 0..n-1; keeps the edges that united something."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def settle(self) -> None:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return
            self.root = up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the ends of all pairs."""
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            high, at = np.unique(high, return_index=True)  # each root is hung up once a round
            self.root[high] = low[at]
            self.edges.append((a[at], b[at]))
            self.settle()


def nodes_of(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the leaves up: bits shared by a node's fingerprints, and their pattern."""
    starts = np.arange(0, len(fp), LEAF)
    both, any_ = np.bitwise_and.reduceat(fp, starts), np.bitwise_or.reduceat(fp, starts)
    levels = [(~(both ^ any_), both)]
    while len(both) > FANOUT:
        starts = np.arange(0, len(both), FANOUT)
        both, any_ = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(any_, starts)
        levels.append((~(both ^ any_), both))
    return levels


def near(levels, level: int, a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    shared, pattern = levels[level]
    return np.bitwise_count((pattern[a] ^ pattern[b]) & shared[a] & shared[b]) <= distance


def unite_block(fp: np.ndarray, distance: int, forest: Forest, base: int) -> None:
    """Unite all links among ``fp`` (in Gray order), elements ``base`` and on of the forest."""
    n = len(fp)
    levels = nodes_of(fp)
    top = len(levels) - 1
    a, b = np.triu_indices(len(levels[top][0]))
    stack = [(top, a, b)]
    while stack:
        level, a, b = stack.pop()
        ok = near(levels, level, a, b, distance)
        a, b = a[ok], b[ok]
        if level:
            step = max(1, FRONTIER // FANOUT**2)
            for i in range(0, len(a), step):
                x = a[i : i + step, None, None] * FANOUT + np.arange(FANOUT)[:, None]
                y = b[i : i + step, None, None] * FANOUT + np.arange(FANOUT)
                x, y = np.broadcast_arrays(x, y)
                fits = (x <= y) & (y < len(levels[level - 1][0]))
                stack.append((level - 1, x[fits], y[fits]))
            continue
        for i in range(0, len(a), 64):
            x = np.minimum(a[i : i + 64, None] * LEAF + np.arange(LEAF), n - 1)
            y = np.minimum(b[i : i + 64, None] * LEAF + np.arange(LEAF), n - 1)
            rx, ry = forest.root[base + x], forest.root[base + y]
            open_ = (rx.min(1) != rx.max(1)) | (ry.min(1) != ry.max(1)) | (rx[:, 0] != ry[:, 0])
            if not open_.any():
                continue  # all of one component already
            x, y = x[open_], y[open_]
            p, r, c = np.nonzero(np.bitwise_count(fp[x][:, :, None] ^ fp[y][:, None, :]) <= distance)
            forest.unite(base + x[p, r], base + y[p, c])


def united(bucket: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links inside each bucket; rows lie in bucket and Gray order."""
    n = len(fp)
    if not n:
        return fp, fp
    forest = Forest(n)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, n])
    size = np.repeat(sizes, sizes)
    for s in range(1, SMALL):
        ok = (bucket[s:] == bucket[:-s]) & (size[s:] <= SMALL) & (np.bitwise_count(fp[s:] ^ fp[:-s]) <= distance)
        at = np.flatnonzero(ok)
        forest.unite(at, at + s)
    for first, k in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        unite_block(fp[first : first + k], distance, forest, int(first))
    if not forest.edges:
        return fp[:0], fp[:0]
    a, b = (np.concatenate(x) for x in zip(*forest.edges, strict=True))
    return fp[a], fp[b]


def links(prints: DataFrame, distance: int, choose: int) -> DataFrame:
    """Edges (a, b) whose components are those of all links among distinct fingerprints ``fp``."""
    spark = prints.sparkSession
    order = roots(distance, choose)
    tops = [sum(n for _, n in o[:choose]) for o in order]

    def lay_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf.fp.to_numpy().view(np.uint64)
            for t, o in enumerate(order):
                rank = gray_rank(moved(fp, o))
                yield pd.DataFrame({"node": np.full(len(fp), t, np.int32), "pattern": (rank >> np.uint64(BITS - tops[t])).view(np.int64), "rank": rank.view(np.int64), "fp": pdf.fp.to_numpy()})

    rows = prints.mapInPandas(lay_out, "node int, pattern long, rank long, fp long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-prints.count() * len(order) // PART_ROWS))
    laid = rows.repartitionByRange(parts, "node", "pattern", "rank").sortWithinPartitions("node", "pattern", "rank")
    laid = kept(laid.withColumn("part", F.spark_partition_id()), "simhash-index")

    def edges_of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node", "pattern", "rank"])
        key = pd.factorize(pd.MultiIndex.from_frame(pdf[["node", "pattern"]]))[0]
        a, b = united(key, pdf.fp.to_numpy().view(np.uint64), distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    inside = laid.groupBy("part").applyInPandas(edges_of, "a long, b long")

    # Parts of one pattern that ended up in several tasks: pairs whose shared bits are near enough.
    spans = laid.groupBy("node", "pattern", "part").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high"))
    several = spans.groupBy("node", "pattern").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    spans = spans.join(several, ["node", "pattern"], "left_semi")
    one, two = (spans.select("node", "pattern", *[F.col(c).alias(f"{c}{i}") for c in ("part", "low", "high")]) for i in (1, 2))
    shared = "~(low1 ^ high1) & ~(low2 ^ high2)"
    pairs = one.join(two, ["node", "pattern"]).filter("part1 < part2").filter(f"bit_count((low1 ^ low2) & {shared}) <= {int(distance)}")
    pairs = pairs.select("node", "pattern", F.struct("node", "pattern", "part1", "part2").alias("pair"), F.explode(F.array("part1", "part2")).alias("part"))
    across = laid.join(pairs, ["node", "pattern", "part"]).groupBy("pair").applyInPandas(lambda pdf: edges_of(pdf[["node", "pattern", "rank", "fp"]]), "a long, b long")
    return kept(inside.union(across).distinct(), "simhash-edges")


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node of the edges but the smallest of its component, with that smallest one."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    seen = None
    while True:
        # Large star: neighbours above a node are hung on the least of the node and its neighbours.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = kept(large, "star")
        # Small star: a node and its smaller neighbours are hung on the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = kept(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "star")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now
        seen = state


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, choose: int = 2) -> DataFrame:
    """Per row of ``docs``: its id, fingerprint ``fp`` and ``component_id``.

    The component is named by the smallest id reachable over links of at most
    ``distance`` differing bits. Texts without words (NULL, empty) have fingerprint
    0 and are linked like any other. Rows may repeat; rows without an id have a
    component but do not name it. ``choose`` blocks make a root's pattern: more
    of them mean smaller groups and more copies of each fingerprint.
    """
    prints = kept(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle).select("doc_id", "fp"), "simhash")
    distinct = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    hung = components(links(distinct.select("fp"), distance, choose))
    named = distinct.join(hung.select(F.col("a").alias("fp"), "b"), "fp", "left").select("fp", "least", F.coalesce("b", "fp").alias("root"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(groups, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One document of each component: that with the smallest id, all its columns.

    Documents are told apart by id and text together, so different texts under
    one id are judged each for itself, and one without an id goes like any other;
    it stays only where no document of its component has an id. Of repeated rows
    one stays.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    groups = near_duplicates(keyed, doc_id="__key", shingle=shingle, distance=distance).select(F.col("doc_id").alias("__key"), "component_id").distinct()
    named = groups.join(keyed.select("__key", F.col("doc_id").alias("__id")).distinct(), "__key")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__key")).alias("first"))
    return keyed.join(first.select("first.__key"), "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
