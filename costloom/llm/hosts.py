"""Quality rules judged per host.

Every document is measured and held against rules. A host's share of failing
documents is shrunk towards the mean of all hosts by a beta prior that is fitted
to the hosts themselves, so a host with few documents is hardly judged by them.
Hosts whose shrunk rate is too high are rejected with all their documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
# A document fails by one of these; the first is the rule of its own.
BASE = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"
RULES = {
    "base": BASE,
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 12 * n_words)",
}


def measure(text: str) -> tuple[int, ...]:
    """MEASURES of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    # Bytes that start a character, less white space: characters in words.
    b = np.frombuffer(raw, np.uint8)
    word_chars = int(np.count_nonzero((b & 0xC0) != 0x80) - np.count_nonzero((b == 32) | ((b >= 9) & (b <= 13))))
    n_symbols = sum(map(raw.count, (c.encode() for c in SYMBOLS)))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if n > 3:
        index: dict[bytes, int] = {}
        ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
        _, pair = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * len(index) + ids[2:]
        _, which, size = np.unique(key, return_inverse=True, return_counts=True)
        twice = size[which] > 1
        hit = np.zeros(n, bool)
        for i in range(3):
            hit[i : n - 2 + i] |= twice
        repeat = int(hit.sum())
    return n, word_chars, n_symbols, len(lines) - len(set(lines)), repeat, len(lines)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures; a NULL text has no words. Columns of the same names are replaced."""

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [measure(x if isinstance(x, str) else "") for x in batch]
            yield pd.DataFrame(rows, columns=list(MEASURES), dtype="int64")

    out = docs.withColumn("__m", run(F.col(text)))
    return out.withColumns({m: F.col(f"__m.{m}") for m in MEASURES}).drop("__m")


def beta_prior(rates: DataFrame) -> tuple[float, float]:
    """Beta parameters by the method of moments over hosts (columns ``fails`` and ``n``).

    Each host counts once. The variance between hosts is what is left after the
    sampling variance of each; without any, the prior is as strong as all rows.
    """
    p = F.col("fails") / F.col("n")
    row = rates.agg(F.avg(p).alias("m"), F.var_pop(p).alias("v"), F.avg(p * (1 - p) / F.col("n")).alias("noise"), F.sum("n").alias("n")).first()
    if row["m"] is None:
        return 1.0, 1.0
    m = min(max(row["m"], 1e-6), 1 - 1e-6)
    between = row["v"] - row["noise"]
    strength = min(max(m * (1 - m) / between - 1, 1.0), float(row["n"])) if between > 0 else float(row["n"])
    return m * strength, (1 - m) * strength


def host_verdicts(failures: DataFrame, host: str, most: float) -> DataFrame:
    """Per host its rows ``n``, ``fails``, shrunk ``rate`` and whether it is rejected.

    ``failures`` has the host and a boolean ``failed``. Rows without a host are
    no host: they are not judged together.
    """
    rates = failures.filter(F.col(host).isNotNull()).groupBy(host).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("fails"))
    a, b = beta_prior(rates)
    rate = (F.col("fails") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    return rates.withColumn("rate", rate).withColumn("rejected", F.col("rate") > most)


def judge(docs: DataFrame, host: str = "source", text: str = "text", most: float = 0.75) -> DataFrame:
    """``docs`` without its text: measures, base_failed, host_rejected and kept.

    A host is rejected when the shrunk share of its documents that fail any rule
    is above ``most``. Kept is every document that neither fails the base rule
    nor stands on a rejected host. A document without a host is judged alone.
    """
    rows = kept(measured(docs, text).drop(text), "host-measures")
    rows = rows.withColumn("base_failed", F.expr(BASE))
    failing = rows.select(host, F.expr(" or ".join(f"({r})" for r in RULES.values())).alias("failed"))
    bad = host_verdicts(failing, host, most).filter("rejected").select(host, F.lit(True).alias("__bad"))
    out = rows.join(bad, host, "left").withColumn("host_rejected", F.coalesce("__bad", F.lit(False))).drop("__bad")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def digest(docs: DataFrame) -> DataFrame:
    out = judge(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected")
