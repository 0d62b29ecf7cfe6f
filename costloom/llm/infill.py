"""Fill-in-the-middle: texts reordered so that a middle part is predicted from both sides.

A text is cut at token borders into prefix, middle and suffix. All work is on its
UTF-8 bytes. Beside them stands a sparse index of the exceptions, the characters
of more than one byte: their places and the excess bytes up to them. A place in
code points is the place in bytes less the excess before it, found by
searchsorted in the index; spans of ASCII need only that subtraction, and a pure
ASCII text has an empty index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: marks of the three parts, and shares in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
REORDERED = 90
SUFFIX_FIRST = 20

LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = LETTER[ord("a") : ord("z") + 1] = True


@dataclass(frozen=True)
class Exceptions:
    """Multibyte characters of a text: byte place and code-point place of each, and excess bytes before it; ``excess`` has the total at its end."""

    at_byte: np.ndarray
    at_point: np.ndarray
    excess: np.ndarray

    @staticmethod
    def of(data: np.ndarray) -> Exceptions:
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        size = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        excess = np.concatenate([[0], np.cumsum(size)])
        return Exceptions(at, at - excess[:-1], excess)

    def points(self, byte):
        """Code-point places of byte places that start a character, or end the text."""
        return byte - self.excess[np.searchsorted(self.at_byte, byte)]

    def bytes(self, point):
        """Byte places of code-point places."""
        return point + self.excess[np.searchsorted(self.at_point, point)]


def token_starts(data: np.ndarray) -> np.ndarray:
    """Byte places where a token starts: a run of letters A-Z a-z is one token, any other character one of its own."""
    letter = LETTER[data]
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


@dataclass(frozen=True)
class Infill:
    tokens: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def transformed(text: bytes, draws: tuple[int, int, int, int]) -> Infill:
    """One text: two cuts, whether to reorder and in which order, by four random numbers."""
    data = np.frombuffer(text, np.uint8)
    starts = token_starts(data)
    n = len(starts)
    if not n or draws[2] % 100 >= REORDERED or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return Infill(n, "plain", None, None, text)
    first, last = (int(starts[k]) if k < n else len(text) for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    cuts = Exceptions.of(data).points(np.array([first, last]))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if draws[3] % 100 < SUFFIX_FIRST:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return Infill(n, form, int(cuts[0]), int(cuts[1] - cuts[0]), output)


def restored(output: bytes, form: str) -> bytes:
    """The text of an output. No part holds a mark, so the first of each is the one that was set."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    head, _, rest = output[len(PREFIX) :].partition(second)
    tail, _, middle = rest.partition(MIDDLE)
    return head + middle + tail if form == "psm" else tail + middle + head


def draws(key: Column, seed: int = 1) -> Column:
    """Four unsigned 32-bit numbers of a row, from the SHA-256 of ``seed:key``; a NULL key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


OUT = "tokens long, form string, prefix_chars long, middle_chars long, output binary"


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, name: str = "infill") -> DataFrame:
    """``docs`` with a struct column ``name`` of tokens, form, prefix_chars, middle_chars and output.

    A NULL text counts as an empty one; an empty text stays plain, as does one
    that holds a mark. Rows of one key and one text give one result. Whatever
    its length, a text is handled whole and alone. A column called ``name`` is
    replaced.
    """

    @F.pandas_udf(OUT)
    def change(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, numbers in batches:
            done = [transformed(bytes(x), tuple(map(int, d))) for x, d in zip(texts, numbers, strict=True)]
            yield pd.DataFrame(
                {
                    "tokens": pd.Series([d.tokens for d in done], dtype="int64"),
                    "form": [d.form for d in done],
                    "prefix_chars": pd.Series([d.prefix_chars for d in done], dtype="Int64"),
                    "middle_chars": pd.Series([d.middle_chars for d in done], dtype="Int64"),
                    "output": [d.output for d in done],
                }
            )

    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.withColumn(name, change(whole, draws(F.col(key), seed)))


def restore(output: Column, form: Column) -> Column:
    """The text (binary) of an output and its form."""

    @F.pandas_udf("binary")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restored(bytes(x), f) for x, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output, form)


def digest(docs: DataFrame) -> DataFrame:
    """Per document its tokens, form, lengths, and the SHA-256 of its output and of the text rebuilt from that."""
    done = fill_in_middle(docs.select("doc_id", "text")).select("doc_id", "infill.*")
    return done.select(
        "doc_id",
        F.col("tokens").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
