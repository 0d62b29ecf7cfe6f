"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest length is cut into full pieces and a rest.
Pieces are dealt by a hash into shards of bounded size; each shard is packed by
itself, longest pieces first. A piece goes to the open bin it fits most closely.
If none has room, a bin is opened: for every permitted length the shard's
remaining pieces tell what would still go in, and the length that costs least
for a token held is taken. When all is packed each bin is cut down to the
shortest permitted length that holds it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

CAPACITIES = (256, 512, 1024, 2048, 4096)
# Cost of a sequence in token units: its length, a fixed share, and attention's square.
FIXED, SQUARE = 16.0, 1 / 65536
SHARD_ROWS = 50_000  # pieces of one shard, on average
COPIES = 10_000  # equal pieces that one row stands for while they are numbered
PACKED = "shard long, bin long, capacity int, slot int, doc_id long, piece int, start long, length int, offset int"


def cost(capacity: int) -> float:
    return FIXED + capacity + SQUARE * capacity * capacity


def pack(lengths: Sequence[int], capacities: Sequence[int]) -> tuple[list[int], list[int]]:
    """(bin of each length, capacity of each bin); ``lengths`` fall and none is above the largest capacity."""
    capacities = sorted(capacities)
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    sizes = sorted(left)  # lengths that still wait

    def taken(n: int) -> None:
        left[n] -= 1
        if not left[n]:
            del left[n]
            sizes.pop(bisect_left(sizes, n))

    def fill(room: int) -> int:
        """Tokens that the waiting pieces would put into ``room``, largest first."""
        held, top = 0, len(sizes)
        while room and (top := bisect_right(sizes, room, 0, top)):
            n = sizes[top - 1]
            times = min(left[n], room // n)
            held += times * n
            room -= times * n
            top -= 1
        return held

    where: list[int] = []
    used: list[int] = []
    opened: list[int] = []
    rooms: list[int] = []  # distinct rooms of open bins, rising
    by_room: dict[int, list[int]] = {}
    for n in lengths:
        taken(n)
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            own = by_room[room]
            b = own.pop()
            if not own:
                del by_room[room]
                rooms.pop(at)
        else:
            b = len(opened)
            options = [c for c in capacities if c >= n]
            best = min(options, key=lambda c: (cost(c) / (n + fill(c - n)), c))
            opened.append(best)
            used.append(0)
            room = best
        where.append(b)
        used[b] += n
        room -= n
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(b)
    final = [next(c for c in capacities if c >= u) for u in used]
    return where, final


def pieces(docs: DataFrame, length: Column, largest: int) -> DataFrame:
    """doc_id, piece, start and length of every piece; documents of no length have none."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), length.cast("long").alias("total")).filter("total > 0")
    numbers = F.sequence(F.lit(0), F.ceil(F.col("total") / largest).cast("int") - 1)
    cut = rows.select("doc_id", "total", F.explode(numbers).alias("piece"))
    start = F.col("piece").cast("long") * largest
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(largest).cast("long"), F.col("total") - start).cast("int").alias("length"))


def copies(cut: DataFrame) -> DataFrame:
    """The same pieces, equal ones numbered by ``copy``.

    They are counted, which combines in every task, and listed again from their
    count in two steps, so that no task numbers more than ``COPIES`` of a piece.
    """
    columns = cut.columns
    counted = cut.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    runs = counted.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(__n - 1) div {0}".format(COPIES)))))
    first = F.col("__run") * COPIES
    each = F.sequence(first, F.least(first + COPIES, F.col("__n")) - 1)
    return runs.repartition(*columns, "__run").withColumn("copy", F.explode(each)).drop("__n", "__run")


def packed(docs: DataFrame, length: Column, capacities: Sequence[int] = CAPACITIES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: shard and bin (together a sequence), its capacity, place and offset in it.

    ``length`` gives the tokens of a row of ``docs``. Every token of every
    document is in just one piece. A NULL length counts as none. Rows without an
    id are packed like others; repeated rows are packed as often as they occur.
    """
    caps = sorted({int(c) for c in capacities if c > 0})
    if not caps:
        raise ValueError("no permitted length")
    rows = kept(copies(pieces(docs, length, caps[-1])), "pieces")
    shards = max(1, -(-rows.count() // shard_rows))
    # Dealt by content and copy, so repeated runs pack alike and equal pieces spread.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length", "copy"), F.lit(shards)))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        where, final = pack(pdf.length.tolist(), caps)
        out = pdf.assign(bin=where, capacity=[final[b] for b in where])
        by = out.groupby("bin", sort=False)
        out["slot"] = by.cumcount()
        out["offset"] = by.length.cumsum() - out.length
        return out[["shard", "bin", "capacity", "slot", "doc_id", "piece", "start", "length", "offset"]]

    return dealt.groupBy("shard").applyInPandas(run, PACKED)


def n_tokens(text: str = "text") -> Column:
    """Words between white space and one end; a NULL text has only its end."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")) + 1
