"""Secrets in texts, found by lexing assignments.

Source and configuration syntax is read as pairs of a name and the terms on its
right: quoted or bare literals and other names, joined by ``+``. A name that was
given a constant before stands for that constant, so a literal is judged by every
name it reaches. A pair scores the sensitivity of the name times the
plausibility of the literal. Three plain patterns are always reported beside it.

The work is linear in the text. Pairs are found from their operators: a name is
read backwards from its operator and never beyond the operator before, so no run
of letters is tried from each of its places. A constant is kept as a summary of
its characters with references to the constants it was built from, so a value
that doubles with every line costs no more than its lines do.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# How sensitive a name is that holds these parts side by side.
SENSITIVE = {
    ("password",): 1.0,
    ("passwd",): 1.0,
    ("passphrase",): 1.0,
    ("pwd",): 0.9,
    ("pass",): 0.7,
    ("secret",): 1.0,
    ("token",): 0.9,
    ("apikey",): 1.0,
    ("api", "key"): 1.0,
    ("access", "key"): 1.0,
    ("private", "key"): 1.0,
    ("signing", "key"): 0.9,
    ("encryption", "key"): 0.9,
    ("auth",): 0.7,
    ("credential",): 0.9,
    ("credentials",): 0.9,
}
HINTS = tuple({w.encode() for parts in SENSITIVE for w in parts[:1]})
PLACEHOLDER = re.compile(r"(?i)^(?:none|null|nil|true|false|undefined|required|optional|changeme|example|placeholder|redacted|todo|x+|\*+|\.+|<.*>|your[-_ ].*|string|str|text)$")
LEAST_SCORE = 0.5

OPERATOR = re.compile(r":=|=>|=(?!=)|:(?!:)")
NAME_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-"
NAME_START = re.compile(r"[A-Za-z_]")
PAIR = re.compile(r"""(?P<q>["']?)[A-Za-z_][A-Za-z0-9_.\-]*(?P=q)\]?[\x20\t]*(?::=|=>|=(?!=)|:(?!:))""")
ANNOTATION = re.compile(r"[\x20\t]*[A-Za-z_][A-Za-z0-9_.\[\]]*[\x20\t]*=(?!=)")
BLANKS = re.compile(r"[\x20\t]*")
TERM = re.compile(r"""(?P<quoted>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|\$\{?(?P<ref>[A-Za-z_][A-Za-z0-9_]*)\}?|(?P<bare>[^\s"'#;,(){}\[\]<>+$]+)""")
PLUS = re.compile(r"[\x20\t]*\+[\x20\t]*")
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*)>(?P<value>[^<>\n]+)</(?P=name)>")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    parts = [p.lower() for p in CAMEL.findall(name)]
    best = 0.0
    for want, score in SENSITIVE.items():
        n = len(want)
        if score > best and any(tuple(parts[i : i + n]) == want for i in range(len(parts) - n + 1)):
            best = score
    return best


HEAD = 64  # characters a summary keeps; every placeholder that is a word is shorter


class Value:
    """What is told of a literal, or of several joined: enough to score it without its characters in order."""

    __slots__ = ("size", "counts", "head", "last", "lead", "trail")

    def __init__(self, text: str):
        self.size, self.counts, self.head, self.last = len(text), Counter(text), text[:HEAD], text[-1:]
        # Leading and trailing blanks, as (characters, spaces among them).
        self.lead = self._blank(text[: len(text) - len(text.lstrip())])
        self.trail = self._blank(text[len(text.rstrip()) :])

    @staticmethod
    def _blank(run: str) -> tuple[int, int]:
        return len(run), run.count(" ")

    def __add__(self, other: Value) -> Value:
        out = object.__new__(Value)
        out.size, out.counts = self.size + other.size, self.counts + other.counts
        out.head, out.last = (self.head + other.head)[:HEAD] if self.size < HEAD else self.head, other.last or self.last
        join = lambda a, b: (a[0] + b[0], a[1] + b[1])
        out.lead = join(self.lead, other.lead) if self.lead[0] == self.size else self.lead
        out.trail = join(self.trail, other.trail) if other.trail[0] == other.size else other.trail
        return out

    def placeholder(self) -> bool:
        if self.size <= HEAD:
            return PLACEHOLDER.match(self.head) is not None
        only = set(self.counts)
        return only <= {"x", "X"} or only == {"*"} or only == {"."} or (self.head[0] == "<" and self.last == ">") or re.match(r"(?i)your[-_ ]", self.head) is not None

    def spaced(self) -> bool:
        """Whether a space stands between other characters."""
        return self.lead[0] < self.size and self.counts[" "] > self.lead[1] + self.trail[1]

    def score(self) -> float:
        """From 0 for a placeholder or a short plain word to 1 for long mixed characters."""
        if self.size < 6 or self.placeholder() or self.spaced():
            return 0.0
        entropy = -sum(n / self.size * math.log2(n / self.size) for n in self.counts.values())
        classes = sum(any(kind(c) for c in self.counts) for kind in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
        return min(1.0, entropy / 4 + 0.15 * (classes - 1))


def literal_score(value: str) -> float:
    return Value(value).score()


class Constant:
    """A name's value: its summary, the literals it was written with, and the constants it refers to."""

    __slots__ = ("value", "spans", "parts", "told")

    def __init__(self, value: Value, spans: list[tuple[int, int]], parts: list[Constant]):
        self.value, self.spans, self.parts, self.told = value, spans, parts, False

    def tell(self, out: set[tuple[int, int]]) -> None:
        """Report all literals behind this constant, each constant's once in a text."""
        todo = [self]
        while todo:
            own = todo.pop()
            if not own.told:
                own.told = True
                out.update(own.spans)
                todo += own.parts


def name_before(text: str, operator: int, low: int) -> str | None:
    """The name an operator assigns to, read backwards from it but not beyond ``low``."""
    left = text[low:operator].rstrip(" \t")
    left = left.removesuffix("]")
    quote = left[-1:] if left[-1:] in ("'", '"') else ""
    left = left.removesuffix(quote) if quote else left
    rest = left.rstrip(NAME_CHARS)
    if quote:
        name = left[len(rest) :]
        return name if rest[-1:] == quote and NAME_START.match(name) else None
    start = NAME_START.search(left, len(rest))
    return left[start.start() :] if start else None


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name."""
    constants: dict[str, Constant] = {}
    out: set[tuple[int, int]] = set()
    at = low = 0
    for op in OPERATOR.finditer(text):
        if op.start() < at:
            continue
        name = name_before(text, op.start(), max(at, low))
        low = op.end()
        if name is None:
            continue
        note = ANNOTATION.match(text, op.end()) if op[0] == ":" else None
        p = BLANKS.match(text, note.end() if note else op.end()).end()
        value, spans, parts = Value(""), [], []
        while t := TERM.match(text, p) if not PAIR.match(text, p) else None:
            p = t.end()
            word = t["ref"] or t["bare"]
            if t["quoted"] is not None:
                value += Value(t["quoted"][1:-1])
                if len(t["quoted"]) > 2:
                    spans.append((t.start() + 1, t.end() - 1))
            elif word in constants:
                value += constants[word].value
                parts.append(constants[word])
            elif t["ref"] is None:
                value += Value(word)
                spans.append(t.span())
            plus = PLUS.match(text, p)
            if not plus:
                break
            p = plus.end()
        at = p
        if spans or parts:
            constants[name] = Constant(value, spans, parts)
            sensitive = name_score(name)
            if sensitive >= LEAST_SCORE and sensitive * value.score() >= LEAST_SCORE:
                constants[name].tell(out)
    for m in ELEMENT.finditer(text):
        sensitive = name_score(m["name"])
        if sensitive >= LEAST_SCORE and sensitive * literal_score(m["value"]) >= LEAST_SCORE:
            out.add(m.span("value"))
    return sorted(out)


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then kind; code points, end exclusive."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    spans: list[tuple[str, int, int]] = []
    if any(w in raw for w in ASSIGN_WORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"akia" in raw:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if (b"=" in raw or b":" in raw or b"</" in raw) and any(w in raw for w in HINTS):
        spans += [("lexed", s, e) for s, e in lexed_spans(text)]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


SPAN = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, text: str = "text", spans: str = "spans", clean: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the spans of secrets, and with the redacted text in column ``clean`` if named.

    A NULL text has no spans and stays NULL; a text is never cut. Columns of
    ``docs`` of the same names are replaced.
    """

    @F.pandas_udf(f"spans {SPAN}, clean string")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            every = [scan(x) if isinstance(x, str) else [] for x in batch]
            texts = [redacted(x, s, mark) if clean and s else None for x, s in zip(batch, every, strict=True)]
            yield pd.DataFrame({"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in every], "clean": texts})

    out = docs.withColumn("__found", look(F.col(text)))
    if clean:
        out = out.withColumn(clean, F.coalesce("__found.clean", F.col(text)))
    return out.withColumn(spans, F.col("__found.spans")).drop("__found")


def n_of(spans, kind: str):
    """Number of spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans, kinds=KINDS):
    """Spans of the given kinds as kind:start:end, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """Per document the counts of the plain patterns, their digest, and all spans.

    A NULL or empty text counts 0 of each, with the digest of nothing and no
    spans; texts are scanned whole whatever their length; a repeated row gives
    its result each time and a NULL doc_id stays NULL; other columns are ignored.
    """
    found = find_secrets(docs.select("doc_id", "text"))
    spans = F.col("spans")
    counts = [n_of(spans, k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(joined(spans, KINDS[:3]), 256).alias("base_sha256"), joined(spans).alias("spans"), counts[3])
