"""Ordered work per key that survives a very hot key.

``top_k`` is a row_number window under a filter on it: Spark keeps at most k
rows per key in every map task (WindowGroupLimit, partial) before the shuffle,
so the size of a key does not matter.

``ordered_scan`` computes running values. A running window puts a whole key into
one task, so every key is cut into chunks that follow the order itself: rows are
range-partitioned by key and order, and a row's partition is its chunk. However
the ids look, a key or a single day with a third of all rows is spread over a
third of the partitions. The chunked rows are written once; every later scan over
them, forward or backward, starts from the same files. Rows are scanned inside
their chunk. Only the first and the last key of a chunk can reach into another
one, so totals are made for those keys alone: at most two a chunk, scanned per
key and added to the rows. Running sums and a running peak of their difference
form one record that combines in the same single scan.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

CHUNK = "__chunk"
_ROW = "__rn"


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """First k rows of each key; ``rank`` keeps the position as a column."""
    name = rank or _ROW
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return out if rank else out.drop(_ROW)


@dataclass(frozen=True)
class Running:
    """One running value.

    ``kind`` is 'sum', 'max', 'last' (last non-null) or 'peak': the greatest value
    so far of a linear expression in the scan's running sums. ``value`` is an
    expression of the row, for a peak one of the names of the sums. ``whole``
    names a further column with the value over all rows of the key.
    """

    name: str
    kind: str
    value: Column
    exclusive: bool = False  # leave the row itself out
    whole: str | None = None


def _over(kind: str, value: Column, window) -> Column:
    if kind == "sum":
        return F.sum(value).over(window)
    if kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    return F.max(value).over(window)


def _total(kind: str, value: Column, position: Column, reverse: bool) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "last":
        seen = F.when(value.isNotNull(), position)
        return F.min_by(value, seen) if reverse else F.max_by(value, seen)
    return F.max(value)


def _combine(kind: str, before: Column, here: Column) -> Column:
    if kind == "sum":
        return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    if kind == "last":
        return F.coalesce(here, before)
    return F.greatest(before, here)


@dataclass(frozen=True)
class Chunks:
    """Rows with their chunk, in chunks that follow ``keys`` and ``order``; ``split`` lists the keys in several chunks."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: DataFrame | None

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Chunks:
        """The same chunks with other columns or with some of the rows."""
        return replace(self, df=change(self.df))

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def scan(self, running: Sequence[Running], reverse: bool = False) -> Chunks:
        """Running values added to the rows, in the order of the chunks or against it."""
        direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
        inner = Window.partitionBy(*self.keys, CHUNK).orderBy(*map(direction, self.order))
        upto, before = (inner.rowsBetween(Window.unboundedPreceding, e) for e in (0, -1))
        all_of = inner.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        plain, peaks = [r for r in running if r.kind != "peak"], [r for r in running if r.kind == "peak"]

        def inside(df: DataFrame) -> DataFrame:
            for own in (plain, peaks):  # a peak is taken of sums
                if own:
                    values = {r.name: _over(r.kind, r.value, before if r.exclusive else upto) for r in own}
                    df = df.withColumns(values | {r.whole: _over(r.kind, r.value, all_of) for r in own if r.whole})
            return df

        out = inside(self.df)
        if self.split is None:
            return replace(self, df=out)

        # Totals of the chunks of split keys; a peak needs the sums inside the chunk.
        some = _with(self.df, self.split, self.keys, "left_semi")
        totals = (inside(some) if peaks else some).groupBy(*self.keys, CHUNK)
        totals = totals.agg(*[_total(r.kind, r.value, F.struct(*self.order), reverse).alias(f"__t_{r.name}") for r in running])
        chunks = Window.partitionBy(*self.keys).orderBy(direction(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.withColumns({r.name: _over(r.kind, F.col(f"__t_{r.name}"), chunks) for r in plain})
        if peaks:
            offsets = offsets.withColumns({r.name: F.coalesce(r.name, F.col(f"__t_{r.name}") * 0) for r in plain if r.kind == "sum"})
            offsets = offsets.withColumns({f"__lift_{r.name}": r.value for r in peaks})
            offsets = offsets.withColumns({f"__t_{r.name}": F.col(f"__lift_{r.name}") + F.col(f"__t_{r.name}") for r in peaks})
            offsets = offsets.withColumns({r.name: _over(r.kind, F.col(f"__t_{r.name}"), chunks) for r in peaks})
        every = Window.partitionBy(*self.keys)
        wholes = [r for r in running if r.whole]
        offsets = offsets.select(
            *self.keys,
            CHUNK,
            *[F.col(r.name).alias(f"__off_{r.name}") for r in running],
            *[f"__lift_{r.name}" for r in peaks],
            *[_over(r.kind, F.col(f"__t_{r.name}"), every).alias(f"__off_{r.whole}") for r in wholes],
        )
        out = _with(out, offsets, [*self.keys, CHUNK], "left")
        local = {r.name: F.col(r.name) + F.coalesce(f"__lift_{r.name}", F.col(r.name) * 0) if r.kind == "peak" else F.col(r.name) for r in running}
        out = out.withColumns(
            {r.name: _combine(r.kind, F.col(f"__off_{r.name}"), local[r.name]) for r in running}
            | {r.whole: F.coalesce(f"__off_{r.whole}", r.whole) for r in wholes}
        )
        return replace(self, df=out.select(*self.df.columns, *[r.name for r in running], *[r.whole for r in wholes]))


def _with(df: DataFrame, few: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join with a table of at most two rows a chunk, so it is always broadcast; NULL keys meet."""
    side = few.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(F.broadcast(side), same, how).drop(*[f"__k_{k}" for k in keys])


def in_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Chunks:
    """``df`` cut into chunks and written once.

    ``order`` must be a total order of each key's rows.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = written(df.repartitionByRange(parts, *keys, *order).withColumn(CHUNK, F.spark_partition_id()))
    key = F.struct(*keys)  # a struct is never NULL, so a NULL key counts as an end too
    ends = marked.groupBy(CHUNK).agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()  # a row a chunk
    held = Counter(k for r in ends for k in {tuple(r["first"]), tuple(r["last"])})
    split = [k for k, n in held.items() if n > 1]
    schema = marked.select(*keys).schema
    return Chunks(marked, tuple(keys), tuple(order), spark.createDataFrame(split, schema) if split else None)


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with each row's position in the whole order, from 1, without a task that sees all rows.

    Rows are range-partitioned by the order and numbered inside their partition;
    the partitions' counts, one row each, give the offsets. ``order`` must be a
    total order, or equal rows take any of their positions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = written(df.repartitionByRange(parts, *order).withColumn(CHUNK, F.spark_partition_id()))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(CHUNK, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(CHUNK).orderBy(*order)).cast("bigint")
    return marked.withColumn(name, place).join(F.broadcast(offsets), CHUNK).withColumn(name, F.col(name) + F.col("__before")).drop(CHUNK, "__before")


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], running: Sequence[Running], reverse: bool = False) -> DataFrame:
    """Running values per key in ``order`` (ascending, or descending if ``reverse``).

    ``order`` must be a total order of non-null columns.
    """
    return in_chunks(df, keys, order).scan(running, reverse).rows()


def asof_by_day(asked: DataFrame, facts: DataFrame, keys: Sequence[str], day: str, value: str, following: bool = False) -> DataFrame:
    """``asked`` with ``value`` of the latest fact on or before its day, or the next on or after it.

    Both sides must hold one row per key and day, so a window never sees more
    than two rows per calendar day however hot the key is.
    """
    left = asked.withColumns({"__asked": F.lit(1), value: F.lit(None).cast(facts.schema[value].dataType)})
    right = facts.select(*keys, day, value).withColumn("__asked", F.lit(0))
    both = left.unionByName(right, allowMissingColumns=True)
    order = [F.col(day).desc(), F.col("__asked").asc()] if following else [F.col(day).asc(), F.col("__asked").asc()]
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn(value, F.last(value, ignorenulls=True).over(window))
    return seen.filter("__asked = 1").drop("__asked")
