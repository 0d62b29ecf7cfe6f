"""Keyed tables whose cost of a batch follows the batch.

A batch adds a delta that holds the rows of the keys it touched, dealt into
buckets by a hash of the key. A reader takes the last base and the deltas after
it, only in the buckets of the keys it asks for, and of each key the row with the
highest batch number. Every ``compact_every`` batches a new base is written, so
no reader meets more deltas than that.

Everything is addressed by batch number: a batch reads what lies below its own
number and overwrites what has it, so a batch repeated after a failure changes
nothing. A delta that should be there and is not is an error, never an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..functions.ordered import top_k

START = -1  # number of the base a table starts from


@dataclass(frozen=True)
class KeyedTable:
    """A table below ``folder`` with at most one live row a key; rows that do not meet ``live`` are only kept as a log."""

    folder: str
    schema: StructType
    key: tuple[str, ...]
    live: str = "true"
    buckets: int = 64
    compact_every: int = 16

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _path(self, spark: SparkSession, kind: str, batch: int):
        """(path, its file system, whether it was written completely)."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}/batch={batch}")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return path, fs, fs.exists(path.suffix("/_SUCCESS"))

    def _write(self, df: DataFrame, kind: str, batch: int) -> None:
        rows = df.select(*self.schema.names).withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{kind}/batch={batch}")

    def _read(self, spark: SparkSession, kind: str, batches: list[int]) -> DataFrame:
        for n in reversed(batches):
            if not self._path(spark, kind, n)[2]:
                raise FileNotFoundError(f"{self.folder}/{kind}/batch={n} is missing")
        paths = [f"{self.folder}/{kind}/batch={n}" for n in batches]
        schema = StructType([*self.schema.fields]).add("batch", IntegerType()).add("bucket", IntegerType())
        return spark.read.schema(schema).option("basePath", f"{self.folder}/{kind}").parquet(*paths)

    def start(self, rows: DataFrame) -> None:
        """Write the table as it is before the first batch, unless that was done."""
        if not self._path(rows.sparkSession, "base", START)[2]:
            self._write(rows, "base", START)

    def delta(self, spark: SparkSession, batch: int) -> DataFrame:
        """The rows one batch wrote."""
        return self._read(spark, "delta", [batch]).drop("batch", "bucket")

    def read(self, spark: SparkSession, before: int, keys: DataFrame | None = None) -> DataFrame:
        """Live rows as the batches below ``before`` left them, of the given keys only if there are any."""
        base = max(START, before // self.compact_every * self.compact_every - 1)
        rows = self._read(spark, "base", [base])
        if base + 1 < before:
            rows = rows.unionByName(self._read(spark, "delta", list(range(base + 1, before))))
        rows = rows.filter(self.live)
        if keys is not None:
            keys = keys.select(*self.key)
            # At most ``buckets`` numbers; the others' folders are not read.
            touched = [r[0] for r in keys.select(self._bucket()).distinct().collect()]
            rows = rows.filter(F.col("bucket").isin(*touched)).join(keys, list(self.key), "left_semi")
        newest = top_k(rows, self.key, [F.col("batch").desc()]) if base + 1 < before else rows
        return newest.select(*self.schema.names)

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows of the keys a batch touched."""
        self._write(rows, "delta", batch)
        self._compact(rows.sparkSession, batch)

    def skip(self, spark: SparkSession, batch: int) -> None:
        """A batch that touched nothing: a mark without rows."""
        path, fs, done = self._path(spark, "delta", batch)
        if not done:
            fs.mkdirs(path)
            fs.create(path.suffix("/_SUCCESS"), True).close()
        self._compact(spark, batch)

    def _compact(self, spark: SparkSession, batch: int) -> None:
        if (batch + 1) % self.compact_every == 0:
            newer = self._read(spark, "delta", list(range(batch + 1 - self.compact_every, batch + 1)))
            older = self._read(spark, "base", [batch - self.compact_every])
            rows = older.unionByName(newer).filter(self.live)
            self._write(top_k(rows, self.key, [F.col("batch").desc()]), "base", batch)
