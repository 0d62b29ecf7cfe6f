"""Classifiers and the language model: held-out quality, exact arithmetic, and odd rows."""

import math
import os
import urllib.parse
import zlib

import numpy as np
import pytest

from costloom.llm import langid, lm, toxicity
from costloom.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


def crc(i, by):
    return zlib.crc32(str(i).encode()) % by


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return table(spark, SF, "documents")


def odd_rows(spark, columns="doc_id long, text string, lang string, source string"):
    return spark.createDataFrame([(1, None, None, None), (2, "", "en", "s"), (3, "12 -- 34", "en", None), (None, "the and of", "en", "s"), (4, "x " * 30000, "de", "s"), (4, "x " * 30000, "de", "s")], columns)


def test_language_held_out(docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.predict_held_out(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if crc(i, 3) == 1}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_phrases_are_those_of_a_plain_parse(docs):
    texts = [r["text"] for r in docs.select("text").limit(40).collect()] + ["", "a", "zzz " * 3000]
    known = [langid.symbols_of(t) for t in texts[:10]]
    nexts = langid.suffix_automaton("\0".join(known)[:30000])
    alphabet = "".join(sorted(set("".join(known)[:30000]) - {"\0"}))
    model = ("x", 1000, alphabet, len(nexts), langid.parse_table(nexts, alphabet).astype(np.int32).tobytes())
    languages = langid.Languages([model, ("y", *model[1:])])
    got = languages.phrases([languages.encode(t) for t in texts])
    for text, counts in zip(texts, got, strict=True):
        phrases, state = 0, None
        for c in langid.symbols_of(text):
            if state is not None and c in nexts[state]:
                state = nexts[state][c]
            else:
                phrases, state = phrases + 1, nexts[0].get(c)
            if state is None:
                state = None
        assert counts.tolist() == [phrases, phrases]


def test_automaton_holds_just_the_substrings():
    parts = ["abab", "bcab", "abab", "caa"]
    nexts = langid.suffix_automaton("\0".join(parts))
    want = {p[i:j] for p in parts for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
    for word in want | {"abb", "ba" * 3, "cc", "bb", "abc", "bca", "bcabb"}:
        state = 0
        for c in word:
            state = nexts[state].get(c)
            if state is None:
                break
        assert (state is not None) == (word in want), word


def test_language_of_odd_rows(spark):
    rows = langid.predict_held_out(odd_rows(spark)).collect()
    assert len(rows) == 6
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["lang_pred"] == by[2]["lang_pred"] == by[3]["lang_pred"] == "und"
    assert by[1]["score"] == 0.0
    assert by[4]["lang_pred"] in ("de", "en")
    assert langid.predict_held_out(odd_rows(spark).filter("false")).collect() == []
    nothing = langid.predict_held_out(odd_rows(spark).selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_toxicity_held_out(spark, docs):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    rows = toxicity.predict_held_out(docs, table(spark, SF, "labels")).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r["doc_id"] for r in rows if crc(r["doc_id"], 5) == 0}
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_of_odd_rows(spark):
    docs = odd_rows(spark).withColumnRenamed("source", "score")
    labels = spark.createDataFrame([(4, 1, "a"), (4, 0, "b"), (3, 0, None), (99, 1, ""), (None, 1, ""), (2, None, "")], "doc_id long, toxic int, text string")
    assert toxicity.predict_held_out(docs, labels).count() == 6
    assert {r["predicted"] for r in toxicity.predict_held_out(docs, labels.filter("false")).collect()} == {0}
    assert toxicity.predict_held_out(docs.filter("false"), labels).collect() == []


@pytest.mark.parametrize("clean, nasty", [("plain words", "plain words"), ("fine words", "nasty insult")])
def test_toxicity_sample_keeps_the_class_shares(spark, clean, nasty):
    rows = [(i, f"{clean} number {i % 7}") for i in range(300)] + [(1000 + i, f"{nasty} number {i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in rows], "doc_id long, toxic int")
    whole, cut = (toxicity.fit(docs, labels, per_class=n).score(["number"])[0] for n in (1000, 40))
    assert abs(np.log(whole / (1 - whole)) - np.log(cut / (1 - cut))) < 0.7


def test_present_features_are_those_of_a_plain_scan():
    texts = ["Abc abd", "", "  xyz", "abcabcabc" * 50]
    slot = np.full(1 << toxicity.BITS, -1, np.int32)
    own = [set(np.concatenate([b for b in toxicity.buckets(toxicity.char_codes([t])[0])] or [np.zeros(0, np.int64)]).tolist()) for t in texts]
    chosen = sorted(set.union(*own))
    slot[chosen] = np.arange(len(chosen))
    got = toxicity.found(texts, slot, len(chosen))
    for t, have in zip(own, got, strict=True):
        assert {chosen[i] for i in np.flatnonzero(have)} == t


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    flat = lm.first_parameters(rng.integers(1, 100, lm.CLASSES)).astype(np.float64)
    c, y = rng.integers(0, lm.CLASSES, (2, 3, lm.WINDOW))
    real = rng.random((3, lm.WINDOW)) > 0.2
    _, g = lm.gradient(lm.unpacked(flat), c, y, real)
    for i in rng.integers(0, len(flat), 40):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = (lm.gradient(lm.unpacked(up), c, y, real)[0] - lm.gradient(lm.unpacked(down), c, y, real)[0]) / 2e-5
        assert abs(slope - g[i]) < 1e-4


def test_windows_score_each_token_once():
    rng = np.random.default_rng(1)
    flat = lm.first_parameters(rng.integers(1, 100, lm.CLASSES))
    m = lm.unpacked(flat.astype(np.float64))
    sizes = np.array([1, 5, lm.WINDOW, lm.WINDOW + 1, 200, 0])
    classes = rng.integers(0, lm.CLASSES, sizes.sum()).astype(np.int16)
    got = lm.Scorer(flat).scores(classes, sizes)

    def row(c):
        x = m["e"][c] + m["p"][: len(c)]
        s = (x @ m["q"]) @ (x @ m["k"]).T / math.sqrt(lm.WIDTH) + np.triu(np.full((len(c), len(c)), -1e9), 1)
        a = np.exp(s - s.max(1, keepdims=True))
        z = (x + (a / a.sum(1, keepdims=True)) @ (x @ m["v"]) @ m["o"]) @ m["u"] + m["b"]
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    ends = np.cumsum(sizes)
    for n, end, score in zip(sizes, ends, got, strict=True):
        own = classes[end - n : end].astype(int)
        given = np.r_[lm.START, own[:-1]] if n else own
        total, at = 0.0, 0
        while at < n:
            first = max(0, at - (lm.CONTEXT if at else 0))
            p = row(given[first : first + lm.WINDOW])
            while at < min(n, first + lm.WINDOW):
                total += p[at - first, own[at]]
                at += 1
        assert abs(total / math.log(10) - score) < 1e-3 * max(1, n)


@pytest.fixture(scope="module")
def ranks(spark):
    return lm.vocabulary(spark, lm.VOCABULARY)


def word_classes(ranks, words):
    size = max(i for _, i in ranks) + 2
    rng = np.random.default_rng(2)
    classes = lm.Classes([lm.END_WORD, b"the"], rng.integers(0, 50, (size, lm.MARKERS)))
    ids, at = lm.Subwords(ranks).encode(words)
    classes.centres = lm.centres_of(classes.vectors(ids, at), np.ones(len(words)))
    return classes, ids, at, size


def test_training_windows_hold_each_token_once(spark, ranks):
    texts = ["", "one", "the end of " * 9 + "it", " ".join(f"word{i}" for i in range(700)), None, "x" * 70_000 + " y"]
    words = sorted({w for x in texts for w in lm.words_of(x or "")})
    classes, ids, at, _ = word_classes(ranks, words)
    group = dict(zip(words, classes.of(words, ids, at).tolist(), strict=True))
    assert group[b"the"] == 1 and len(set(group.values())) > 5
    rows = lm.training_windows(spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1), ranks, classes).collect()
    windows = np.array([np.frombuffer(r["w"], np.int16) for r in rows])
    want = [g for x in texts for g in [*(group[w] for w in lm.words_of(x or "")), 0]]
    assert sorted(windows[:, 1:][lm.trained(windows)].tolist()) == sorted(want)
    assert (windows[:, 0] == lm.START).sum() >= len(texts)


def test_attention_reads_the_subword_ids(spark, ranks):
    texts = ["the word word7 unsplittableish", "", " ".join(f"word{i} the" for i in range(60)), "x" * 9000 + " y z"]
    words = sorted({w for x in texts for w in lm.words_of(x)})
    classes, ids, at, size = word_classes(ranks, words)
    spelled = {w: ids[a:b].tolist() for w, a, b in zip(words, at[:-1], at[1:], strict=True)}
    rows = lm.training_windows(spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1), ranks, classes).collect()
    got = []
    for r in rows:
        n, own = np.frombuffer(r["size"], np.int32), np.frombuffer(r["ids"], np.int32)
        assert n.sum() == len(own) and (n > 0).sum() <= lm.WINDOW
        got.append([own[b - k : b].tolist() for k, b in zip(n, np.cumsum(n), strict=True) if k])
    want = []
    for x in texts:
        own = lm.words_of(x)
        first = [0, *range(lm.STEP, len(own) + 1 - lm.CONTEXT, lm.STEP)] if len(own) + 1 > lm.WINDOW else [0]
        for i in first:
            want.append([spelled[w] for w in own[max(0, i - 1) : i + lm.WINDOW - 1]])
    assert sorted(got) == sorted(want)
    # Vectors of the ids met are learned, of others not; they change the probability of what follows.
    flat, table = lm.train_model(spark.createDataFrame(rows), lm.first_parameters(np.ones(lm.CLASSES)), rounds=2, size=size)
    met = {i for w in spelled.values() for i in w}
    assert set(np.flatnonzero(np.abs(table).sum(1)).tolist()) <= met and np.abs(table[spelled[b"word7"]]).sum() > 0
    number, sizes = np.array([0, 1, 2]), np.array([3])
    scorer, same = lm.Scorer(flat), np.array([5, 5, 0])
    plain = scorer.scores(same, sizes, number, np.zeros((3, lm.WIDTH), np.float32))
    assert np.allclose(plain, scorer.scores(same, sizes))
    assert abs(scorer.scores(same, sizes, number, lm.joined(table, np.array(spelled[b"word7"]), np.array([len(spelled[b"word7"]), 0, 0]))) - plain)[0] > 1e-6


def test_training_windows_take_little_disk(spark, ranks):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in ("un", "re", "ab", "kö") for b in ("do", "turn", "zzz", "lich") for c in range(40)]
    texts = [" ".join(words[i] for i in rng.zipf(1.3, 400) % len(words)) for _ in range(500)]
    classes, *_ = word_classes(ranks, [w.encode() for w in words])
    windows = lm.training_windows(spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1), ranks, classes)
    took = sum(os.path.getsize(urllib.parse.urlparse(x).path) for x in windows.inputFiles())
    assert took < 0.65 * sum(len(x.encode()) for x in texts)


def test_mean_vector_of_words_of_any_length():
    rng = np.random.default_rng(6)
    vectors, size = rng.normal(size=(50, lm.WIDTH)).astype(np.float32), np.array([0, 3, 40, 0, lm.PLACES + 1, lm.PLACES, 1])
    ids = rng.integers(0, 50, size.sum())
    ends = np.cumsum(size)
    for got, n, end in zip(lm.joined(vectors, ids, size), size, ends, strict=True):
        assert np.allclose(got, vectors[ids[end - n : end]].mean(0) if n else 0, atol=1e-6)
    assert lm.joined(vectors, ids[:0], size[:0]).shape == (0, lm.WIDTH)
    assert not lm.joined(vectors, ids[:0], np.zeros(3, np.int64)).any()


def test_slope_of_what_subword_ids_add():
    rng = np.random.default_rng(3)
    m = lm.unpacked(lm.first_parameters(rng.integers(1, 100, lm.CLASSES)).astype(np.float64))
    c, y = rng.integers(0, lm.CLASSES, (2, 3, lm.WINDOW))
    real, own = rng.random((3, lm.WINDOW)) > 0.2, rng.normal(0, 0.3, (3 * lm.WINDOW, lm.WIDTH))
    slope = own.copy()
    lm.gradient(m, c, y, real, slope)
    for i, j in zip(rng.integers(0, len(own), 20), rng.integers(0, lm.WIDTH, 20), strict=True):
        up, down = own.copy(), own.copy()
        up[i, j] += 1e-5
        down[i, j] -= 1e-5
        assert abs((lm.gradient(m, c, y, real, up)[0] - lm.gradient(m, c, y, real, down)[0]) / 2e-5 - slope[i, j]) < 1e-4
    # One more vector for the input is one more row of the tables.
    flat = np.concatenate([m[n].ravel() for n in lm.SHAPES]).astype(np.float32)
    vectors = rng.normal(0, 0.3, (7, lm.WIDTH)).astype(np.float32)
    number, classes = rng.integers(0, 7, lm.WINDOW), rng.integers(0, lm.CLASSES, lm.WINDOW)
    got = lm.Scorer(flat).scores(classes, np.array([lm.WINDOW]), number, vectors)[0]
    given = np.concatenate([np.zeros((1, lm.WIDTH)), vectors[number[:-1]]])
    loss = lm.gradient(m, np.r_[lm.START, classes[:-1]][None], classes[None], np.ones((1, lm.WINDOW), bool), given)[0]
    assert abs(-loss * lm.WINDOW / math.log(10) - got) < 1e-3 * lm.WINDOW


def test_class_is_that_of_the_nearest_centre(ranks):
    words = [b"hello", b"anderenzwei", "été".encode(), b"x" * 3000, b"the", b"\xff\xfe"]
    classes, ids, at, _ = word_classes(ranks, words)
    for w, first, end, got in zip(words, at[:-1], at[1:], classes.of(words, ids, at), strict=True):
        t = classes.common + sum(classes.ratio[i].astype(float) for i in ids[first:end])
        p = np.exp(t - t.max())
        far = ((classes.centres - np.sqrt(p / p.sum())) ** 2).sum(1)
        assert got == 1 if w == b"the" else far[got - lm.OWN] < far.min() + 1e-4


def test_probabilities_inside_a_class_sum_to_one(ranks):
    words = [f"{a}{b}".encode() for a in ("un", "re", "ab", "kö") for b in ("do", "turn", "zzz", "lich")] + [b"the"]
    classes, ids, at, size = word_classes(ranks, words)
    group, n = classes.of(words, ids, at), np.arange(1, len(words) + 1)
    table = np.zeros(lm.Spelling.size(size), np.int64)
    for cell, amount in lm.Spelling.counted(group, n, ids, at, size):
        np.add.at(table, cell, amount)
    spelling = lm.Spelling(table, size)
    for g in set(group.tolist()) - {1}:
        known = (n[group == g] - lm.DISCOUNT).sum()
        assert abs((known + 10 ** spelling.rest[g]) / 10 ** spelling.whole[g] - 1) < 1e-9
        assert all(abs((10.0 ** t[g - lm.OWN]).sum() - 1) < 1e-3 for t in (*spelling.places, spelling.lengths))
    unknown = spelling.unknown(group, ids, at)
    for i, g in enumerate(group):
        own = ids[at[i] : at[i + 1]]
        k = g - lm.OWN
        want = 0.0 if g < lm.OWN else spelling.rest[g] + spelling.places[0][k, own[0]] + spelling.places[1][k, own[1:]].sum() + spelling.lengths[k, len(own) - 1]
        assert abs(unknown[i] - want) < 1e-5
    long = lm.Subwords(ranks).encode([b"qzx" * 50])
    assert spelling.unknown(classes.of([b"qzx" * 50], *long), *long)[0] < -50


def test_every_round_is_one_pass_at_every_size(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    plain = lm.Adam.step

    def counted(self, windows):
        seen.add(len(windows))
        return plain(self, windows)

    monkeypatch.setattr(lm.Adam, "step", counted)
    rng = np.random.default_rng(0)
    for n in (1, 70, 1100):
        rows = rng.integers(0, lm.CLASSES, (n, lm.WINDOW + 1)).astype(np.int16)
        before = seen.value
        lm.train_model(spark.createDataFrame([(bytearray(x.tobytes()),) for x in rows], "w binary"), lm.first_parameters(np.ones(lm.CLASSES)), rounds=2)
        assert seen.value - before == 2 * n


def test_lm_scores(spark, docs):
    rows = lm.scores(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    counts: dict = {}
    for i, t in texts.items():
        if crc(i, 10):
            for w in [*t.encode().lower().split(), b""]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = [*texts[r["doc_id"]].encode().lower().split(), b""]
        assert r["held_out"] == (crc(r["doc_id"], 10) == 0)
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), n)
        assert r["n_known"] == sum(w in counts for w in own)
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert abs(base - r["base_score"]) < 1e-6 * abs(base)
        assert r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_of_odd_rows(spark):
    rows = lm.scores(odd_rows(spark).withColumnRenamed("source", "score")).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 6 and by[1]["n_tokens"] == by[2]["n_tokens"] == 1 and by[None]["n_tokens"] == 4
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in rows)
    assert lm.scores(odd_rows(spark).filter("false")).collect() == []
