"""Cuts, the exception index and the exact way back, against plain string code."""

import hashlib
import random
import re

import numpy as np
import pytest

from costloom.llm import infill
from costloom.llm.common import prepare, table

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    """The contract with Python strings."""
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n, h = len(tokens), hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def draws(doc_id):
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    return tuple(int(h[i : i + 8], 16) for i in (0, 8, 16, 24))


TEXTS = ["", "a", "é", "ab cd", "naïve café — 東京 𝄞𝄞 x", "<P>", "a<S>b", "<<<S<P M>", "\n\r\n\t ", "\x00é\x7f", "𝄞" * 50, "word " * 30_000, "ß" * 100_000, "a" * 200_000, "<P", "S>" * 40, "é ‍ ﻿"]


def test_texts_of_all_kinds():
    rng = random.Random(4)
    alphabet = ["a", "Z", " ", "\n", "é", "東", "𝄞", "<", "P", "S", "M", ">", "1", "ab"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    forms = set()
    for i, text in enumerate(texts):
        got = infill.transformed(text.encode(), draws(i))
        assert (got.tokens, got.form, got.prefix_chars, got.middle_chars, got.output.decode()) == brute(i, text)
        assert infill.restored(got.output, got.form) == text.encode()
        forms.add(got.form)
    assert forms == {"plain", "psm", "spm"}


def test_places_go_both_ways():
    for text in TEXTS:
        data = np.frombuffer(text.encode(), np.uint8)
        index = infill.Exceptions.of(data)
        assert len(index.at_byte) == sum(ord(c) > 127 for c in text)
        if len(text) <= 1000:
            points = np.arange(len(text) + 1)
            places = np.array([len(text[:i].encode()) for i in points])
            assert (index.bytes(points) == places).all() and (index.points(places) == points).all()


def test_digest(spark):
    prepare(spark)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (None, None), (7, None), (3, "ab cd"), (3, "ab cd")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, tokens int")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t in rows:
        n, form, p, m, output = brute("" if i is None else i, t)
        want.append((i, n, form, p, m, sha(output), sha(t or "")))
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(map(tuple, infill.digest(docs).collect()), key=order) == sorted(want, key=order)
    assert infill.digest(docs.filter("false")).count() == 0
    # Columns of the same names stay, but for the one that is asked for.
    kept = infill.fill_in_middle(docs, name="output")
    assert kept.columns == docs.columns and kept.first()["tokens"] == 1


@pytest.mark.parametrize("seed", [2, 3])
def test_another_seed_cuts_elsewhere(spark, seed):
    prepare(spark)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    cuts = lambda s: [r[0] for r in infill.fill_in_middle(docs, seed=s).orderBy("doc_id").select("infill.prefix_chars").collect()]
    assert cuts(1) != cuts(seed)
