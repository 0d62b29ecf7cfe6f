"""WARC archives: written and read by Spark's own text files, verified as chains.

A file is a row of records, each a header, a block and two line ends. Reading
splits files anywhere: the magic that opens a record is taken as line separator,
so a task sees the stretch after every magic of its split, be it a record or a
lookalike inside a payload. Each gives a candidate edge from its offset to that
of its successor. Inside a split chains are followed at once; what leaves a split
is an edge between splits, and pointer jumping from each file's start over those
edges finds the entries that can be reached. Only records on a chain from there
are kept. Payloads that hold the magic are put together from their stretches.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, shared_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
M = len(MAGIC)
LENGTH = re.compile(rb"(?:^|\r\n)content-length:[ \t]*(\d+)[ \t]*(?:\r\n|$)", re.I)


def base32_sha1(content: Column) -> Column:
    """Upper-case base32 of the SHA-1, 20 bits of the hex text at a time."""
    digest = F.sha1(content)
    parts = []
    for i in range(8):
        v = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """One row per page with its record as ``value``.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the
    smallest page_id is a response and the others revisit it. A NULL html is an
    empty payload. Repeated rows of that smallest id are all responses; pages
    without an id are responses that name no page. Every record has an id of its
    own and the time of writing as its date; a revisit names the address and date
    of what it repeats. The page's id is a field beside these.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("body"))
    rows = rows.withColumns({"size": F.octet_length("body").cast("long"), "digest": base32_sha1(F.col("body").cast("binary"))})
    big = rows.filter(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count(F.lit(1)).alias("n")
    )
    # Written, so that the planner knows its true size before it chooses a join.
    shared = kept(big.filter("n > 1 and first is not null").select("digest", "first", "first_url"), "warc-shared")
    rows = rows.join(shared, "digest", "left").withColumn("first", F.when((F.col("size") >= least_bytes) & (F.col("page_id") > F.col("first")), F.col("first")))
    again = F.col("first").isNotNull()
    uri = lambda c: F.regexp_replace(F.regexp_replace(c, "\r", "%0D"), "\n", "%0A")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    block = F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("body")))
    length = F.when(again, F.lit(len(HTTP))).otherwise(F.col("size") + len(HTTP))
    fields = [
        ("WARC-Type", F.when(again, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))),
        ("WARC-Date", now),
        ("WARC-Target-URI", uri("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("X-Payload-Length", F.col("size").cast("string")),
        ("WARC-Refers-To-Target-URI", F.when(again, uri("first_url"))),
        ("WARC-Refers-To-Date", F.when(again, now)),
        ("X-Page-ID", F.col("page_id").cast("string")),
        ("X-Refers-To-Page", F.when(again, F.col("first").cast("string"))),
        ("WARC-Profile", F.when(again, F.lit(PROFILE))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", length.cast("string")),
    ]
    head = F.concat_ws("\r\n", *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in fields])
    return rows.select("page_id", F.concat(F.lit(MAGIC), head, F.lit(END), block).alias("value"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of all pages below ``path``: the text writer's line end closes each record."""
    records(pages, least_bytes).select("value").write.option("lineSep", END).text(path)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, colon, v = line.partition(":")
        if colon:
            out[k.strip().lower()] = v.strip()
    return out


def _stretches(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic (and what stands before the first), in file order inside a split."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("raw"))


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, split, offset in the split, bytes) of each stretch."""
    at, now = 0, None
    for pdf in batches:
        for file, split, raw in zip(pdf.file, pdf.split, pdf.raw, strict=True):
            if (file, split) != now:
                now, at = (file, split), 0
            yield file, split, at, bytes(raw)
            at += len(raw) + M


def _payload(block: bytes) -> bytes:
    """What follows the HTTP header."""
    cut = block.find(b"\r\n\r\n")
    return block[cut + 4 :] if block.startswith(b"HTTP/") and cut >= 0 else block


def _sha(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


CANDIDATE = "file string, split long, at long, size long, next long, whole boolean, head binary, length long, digest string, payload binary"


def _candidates(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    """One row per stretch: its offset in the split and, if it opens with a header, that of its successor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        held = 0
        for file, split, at, raw in _placed(batches):
            cut = raw.find(b"\r\n\r\n")
            found = LENGTH.search(raw, 0, cut) if cut >= 0 and not (split == 0 and at == 0) else None
            if not found:
                rows.append((file, split, at, len(raw), -1, False, None, None, None, None))
            else:
                end = cut + 4 + int(found[1])
                whole = len(raw) == end + 4 and raw.endswith(b"\r\n\r\n")
                body = _payload(raw[cut + 4 : end]) if whole else None
                rows.append((file, split, at, len(raw), at + end + 4 + M, whole, raw[:cut], None if body is None else len(body), None if body is None else _sha(body), body if with_payload else None))
                held += len(body or b"") if with_payload else 0
            if len(rows) >= 1000 or held > 8_000_000:
                yield pd.DataFrame(rows, columns=names)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    names = [x.split()[0] for x in CANDIDATE.split(", ")]
    return _stretches(spark, path).mapInPandas(run, CANDIDATE)


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each stretch of a split: where the chain through it leaves the split, -1 if it breaks."""
    pdf = pdf.sort_values("at")
    at, nxt = pdf["at"].to_numpy(), pdf["next"].to_numpy().copy()
    total = int(pdf["top"].iloc[0])
    for i in range(len(at) - 1, -1, -1):
        if 0 <= nxt[i] < total + M:
            j = np.searchsorted(at, nxt[i])
            nxt[i] = nxt[j] if j < len(at) and at[j] == nxt[i] else nxt[i] if nxt[i] >= total else -1
    return pd.DataFrame({"file": pdf.file, "split": pdf.split, "at": at + pdf.base.to_numpy(), "to": np.where(nxt >= 0, nxt + pdf.base.to_numpy(), -1)})


def _marked(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whether each stretch of a split is on the chain from the split's entry, and the record that owns it."""
    pdf = pdf.sort_values("at")
    at, nxt = pdf["at"].to_numpy(), pdf["next"].to_numpy()
    on = np.zeros(len(at), bool)
    entry = pdf["entry"].iloc[0]
    i = np.searchsorted(at, entry - pdf["base"].iloc[0]) if pd.notna(entry) else len(at)
    want = entry - pdf["base"].iloc[0] if pd.notna(entry) else -1
    while i < len(at) and at[i] == want:
        on[i] = True
        want = nxt[i]
        if want <= at[i]:
            break
        i = np.searchsorted(at, want)
    owner = pd.Series(np.where(on, at, np.nan)).ffill().to_numpy() + pdf.base.to_numpy()
    return pd.DataFrame({"file": pdf.file, "split": pdf.split, "at": at, "on_chain": on, "owner": owner})


def _reached(nodes: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, at) of entries reachable from the starts, by pointer jumping over (file, at, to)."""
    jump = kept(nodes.filter("to >= 0"), "warc-jump")
    reached = kept(starts, "warc-reached")
    while not jump.isEmpty():
        more = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = kept(reached.union(more).distinct(), "warc-reached")
        after = jump.select("file", F.col("at").alias("to"), F.col("to").alias("last"))
        jump = kept(jump.join(after, ["file", "to"]).select("file", "at", F.col("last").alias("to")), "warc-jump")
    return reached


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record on the chain of its file.

    file, offset (of the magic), head (header lines), payload_bytes,
    payload_digest and, if asked for, payload, all of the stored payload. A file
    whose chain breaks gives the records before the break. An empty file has none.
    """
    rows = kept(_candidates(spark, path, with_payload), "warc-candidates")
    light = rows.select("file", "split", "at", "next", "size")
    # Every stretch but a file's last is followed by a magic, so split sizes give split offsets.
    splits = light.groupBy("file", "split").agg(F.max(F.col("at") + F.col("size") + M).alias("top"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = kept(splits.withColumn("base", F.coalesce(F.sum("top").over(before), F.lit(0))), "warc-splits")
    full = light.join(splits, ["file", "split"])
    exits = kept(full.groupBy("file", "split").applyInPandas(_exits, "file string, split long, at long, to long"), "warc-exits")
    starts = splits.filter("split = 0").select("file", F.lit(M).cast("long").alias("at"))
    entries = exits.select("file", F.col("to").alias("at")).filter("at >= 0").union(starts).distinct()
    nodes = exits.join(entries, ["file", "at"]).select("file", "split", "at", "to")
    reached = _reached(nodes.select("file", "at", "to"), starts)
    # A chain enters a split once.
    entry = nodes.join(reached, ["file", "at"]).groupBy("file", "split").agg(F.min("at").alias("entry"))
    marked = full.join(entry, ["file", "split"], "left").groupBy("file", "split").applyInPandas(_marked, "file string, split long, at long, on_chain boolean, owner double")
    marked = kept(marked, "warc-marked")
    out = rows.join(marked.filter("on_chain").select("file", "split", "at"), ["file", "split", "at"]).join(splits.select("file", "split", "base"), ["file", "split"])
    out = out.withColumn("offset", F.col("base") + F.col("at") - M)
    columns = ["file", "offset", "head", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), *(["payload"] if with_payload else [])]
    whole = out.filter("whole").select(*columns)
    parts = kept(out.filter("not whole").select("file", "offset", "head"), "warc-parts")
    if parts.isEmpty():
        return whole
    return whole.unionByName(_assembled(spark, path, parts, marked, splits, with_payload))


def _assembled(spark, path, parts, marked, splits, with_payload) -> DataFrame:
    """Records whose payload holds the magic, put together from their stretches."""
    # A stretch before the first record of its split belongs to the last record of a split before.
    last = marked.groupBy("file", "split").agg(F.max("owner").alias("tail"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("carry", F.max("tail").over(before)).select("file", "split", "carry")
    owned = marked.join(last, ["file", "split"]).withColumn("offset", F.coalesce("owner", "carry").cast("long") - M)
    owned = owned.join(parts, ["file", "offset"]).join(splits.select("file", "split", "base"), ["file", "split"]).select("file", "split", "at", "offset", "head", (F.col("base") + F.col("at")).alias("place"))

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for file, split, at, raw in _placed(batches):
            yield pd.DataFrame({"file": [file], "split": [split], "at": [at], "raw": [raw]})

    raws = _stretches(spark, path).mapInPandas(again, "file string, split long, at long, raw binary").join(owned, ["file", "split", "at"])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        raw = MAGIC.encode().join(bytes(x) for x in pdf.raw)
        cut = raw.find(b"\r\n\r\n")
        end = cut + 4 + int(LENGTH.search(raw, 0, cut)[1])
        out = {"file": [pdf.file.iloc[0]], "offset": [pdf.offset.iloc[0]], "head": [pdf["head"].iloc[0]]}
        if len(raw) < end:  # the file ends inside this record
            return pd.DataFrame({**out, "payload_bytes": [], "payload_digest": []} | {k: [] for k in out})
        body = _payload(raw[cut + 4 : end])
        return pd.DataFrame(out | {"payload_bytes": [len(body)], "payload_digest": [_sha(body)], "payload": [body if with_payload else None]})

    built = raws.groupBy("file", "offset").applyInPandas(build, "file string, offset long, head binary, payload_bytes long, payload_digest string, payload binary")
    return built if with_payload else built.drop("payload")


def header(name: str) -> Column:
    """Value of a header field of ``head``, NULL if absent."""
    text = F.concat(F.lit("\r\n"), F.col("head").cast("string"), F.lit("\r\n"))
    found = F.regexp_extract(text, f"(?i)\\r\\n{re.escape(name)}:[ \\t]*([^\\r\\n]*)\\r\\n", 1)
    return F.when(found != "", found)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archives of ``pages`` written and read back: one row per record.

    A revisit's payload is that of its response, so its size and digest are those
    its header states; a response's are computed from what was read.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_warc(pages, path, least_bytes)
    found = read_warc(spark, path, with_payload=False)
    kind = header("WARC-Type")
    again = kind == "revisit"
    return found.select(
        header("X-Page-ID").cast("long").alias("page_id"),
        F.when(again, header("X-Payload-Length").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.substring_index(header("WARC-Payload-Digest"), ":", -1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        kind.alias("record_type"),
        header("X-Refers-To-Page").cast("long").alias("refers_to"),
    )
