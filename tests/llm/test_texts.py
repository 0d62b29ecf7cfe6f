"""Text operators against plain definitions, and odd rows."""

import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from costloom.llm import credentials, decontam, hosts, licenses, packing, simhash
from costloom.llm.common import prepare, table
from costloom.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return table(spark, SF, "documents")


def odd_rows(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, " \t\n ", None), (None, "mit license password=abcdef1", "s"), (4, "w " * 40000 + "MIT License", "s"), (5, "mit license", "s"), (5, "mit license", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("spans", F.lit("own")).withColumn("n_words", F.lit(7))


def words(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


# Secrets


def base_spans(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [x for _, _, x in sorted(out)]


def test_secret_digest(spark, docs):
    extra = spark.createDataFrame([(9000, 'é token:abc password= "abcdef" PASSWD:x1 secret: token = abcdefgh AKIAAKIA' + "A" * 20 + " " + "0f" * 30, "en", "s", 1), (9001, None, "en", "s", 0)], docs.schema)
    texts = {r["doc_id"]: r["text"] for r in docs.union(extra).select("doc_id", "text").collect()}
    rows = credentials.digest(docs.union(extra)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base_spans(texts[r["doc_id"]] or "")
        kinds = [x.split(":")[0] for x in want]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",")) | {""}


def test_assignments_are_lexed():
    text = 'seed = "Zx9" + "81kkLmnQ"\ndb_password = seed\nfoo = "Zx981kkLmnQ0"\nexport CLIENT_SECRET=${seed}\n<apiKey>abcDEF123456</apiKey>\n{"private_key": "q1W2e3R4t5", "auth": "changeme"}'
    got = [text[s:e] for s, e in credentials.lexed_spans(text)]
    assert got == ["Zx9", "81kkLmnQ", "abcDEF123456", "q1W2e3R4t5"]
    assert credentials.lexed_spans("the token of the realm: none; password: required") == []


def test_secrets_of_odd_rows(spark):
    rows = credentials.find_secrets(odd_rows(spark), clean="clean").collect()
    assert len(rows) == 7
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["clean"] is None and by[2]["clean"] == "" and by[1]["spans"] == []
    assert by[None]["clean"] == "mit license [SECRET]"
    assert credentials.digest(odd_rows(spark).filter("false")).collect() == []


# Hosts


def test_measures(docs):
    for text in [r["text"] for r in docs.collect()] + ["", "a b c", "a b c a b c", "é é é é é\n\né é é é é\n \n", "x\x0by\x1cz   <|>"]:
        own = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        seen, hit = {}, set()
        for i in range(len(own) - 2):
            seen.setdefault(tuple(own[i : i + 3]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                hit |= {i + k for i in at for k in range(3)}
        want = (len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit), len(lines))
        assert hosts.measure(text) == want


def test_bad_hosts_are_rejected(spark):
    good, bad = " ".join(f"word{i}" for i in range(60)), "too short"
    rows = [(i, good if i % 10 else bad, f"h{i % 12}") for i in range(1200)] + [(5000 + i, bad if i % 20 else good, "spam") for i in range(400)] + [(9000, good, "one"), (9001, good, None), (9002, bad, None)]
    out = {r["doc_id"]: r for r in hosts.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(out[5000 + i]["kept"] for i in range(400)) and out[5000]["host_rejected"]
    assert all(out[i]["kept"] == bool(i % 10) for i in range(1200))
    assert out[9000]["kept"] and out[9001]["kept"] and not out[9002]["kept"]


def test_host_digest_of_odd_rows(spark):
    rows = hosts.digest(odd_rows(spark)).collect()
    assert len(rows) == 7
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["base_failed"] and by[4]["n_words"] == 40002
    assert by[4]["n_repeat_words"] == 40000
    assert hosts.digest(odd_rows(spark).filter("false")).collect() == []


# Licenses


def test_license_digest(spark, docs):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    extra = [(9000, "MIT-license; the mit license. Apache License GENERAL public licenſe", "en", "s", 1), (9001, "general public general public license license mit", "en", "s", 1), (9002, None, "en", "s", 0)]
    every = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = {r["doc_id"]: r for r in licenses.digest(every).collect()}
    for d in every.collect():
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), d["text"] or ""))
        at = [(i, label) for p, label in phrases.items() for i in range(len(own)) if tuple(own[i : i + len(p)]) == p]
        r = rows[d["doc_id"]]
        places = [i for i, _ in at]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(own), len(at), min(places, default=None), max(places, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_license_texts_with_changes(spark):
    mit = licenses.TEXTS[0][1].split()
    near = " ".join(mit[:9] + ["very"] + mit[9:])
    far = " ".join(reversed(mit))
    df = spark.createDataFrame([(1, "intro text " + near), (2, far), (3, " ".join(mit[:5]))], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.digest(df).collect()}
    assert got == {1: "mit", 2: "", 3: ""}


def test_licenses_of_odd_rows(spark):
    rows = licenses.digest(odd_rows(spark)).collect()
    assert len(rows) == 7
    by = {r["doc_id"]: r for r in rows}
    assert by[None]["base_labels"] == "mit" and by[4]["first_word"] == 40000 and by[5]["n_base"] == 0 and by[5]["n_words"] == 1
    assert licenses.digest(odd_rows(spark).filter("false")).collect() == []


# SimHash


def plain_fingerprint(text):
    import xxhash

    own = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = words(own)
    if not own:
        return 0
    h = [xxhash.xxh64(" ".join(own[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(own) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash_components(spark, docs):
    base = [r["text"] for r in docs.limit(20).collect()]
    extra = [(9000 + i, base[i % 20] + (f" tail{i}" if i % 3 else ""), "en", "s", 0) for i in range(60)] + [(8000, "", "en", "s", 0), (8001, None, "en", "s", 0), (8002, "one two", "en", "s", 0)]
    every = docs.union(spark.createDataFrame(extra, docs.schema))
    texts = {r["doc_id"]: r["text"] for r in every.collect()}
    prints = {i: plain_fingerprint(t) for i, t in sorted(texts.items())}
    want = plain_components(prints)
    rows = simhash.digest(every).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]]
    kept = {r["doc_id"] for r in simhash.deduplicated(every).collect()}
    assert kept == set(want.values())


@pytest.mark.parametrize("choose", [2, 3])
def test_no_link_is_lost_in_a_crowd(spark, choose):
    import random

    rng = random.Random(3)
    heart = rng.getrandbits(63)
    prints = {rng.getrandbits(63) for _ in range(100)}
    while len(prints) < 700:  # chains around one heart, so that patterns are crowded
        x = rng.choice([heart, *list(prints)[:50]])
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randint(0, 62)
        prints.add(x)
    by = {i: x for i, x in enumerate(sorted(prints))}
    want = plain_components(by)
    old = simhash.PART_ROWS
    simhash.PART_ROWS = 300  # patterns lie across many tasks
    try:
        edges = simhash.links(spark.createDataFrame([(x,) for x in by.values()], "fp long"), 4, choose)
        hung = {r["a"]: r["b"] for r in simhash.components(edges).collect()}
    finally:
        simhash.PART_ROWS = old
    groups = {}
    for i, x in by.items():
        groups.setdefault(want[i], set()).add(hung.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_of_odd_rows(spark):
    rows = simhash.digest(odd_rows(spark)).collect()
    assert len(rows) == 7
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["component_id"] == by[2]["component_id"] == by[3]["component_id"] == 1 and by[5]["component_id"] == 5
    assert simhash.digest(odd_rows(spark).filter("false")).collect() == []
    left = simhash.deduplicated(odd_rows(spark))
    assert left.columns == odd_rows(spark).columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "4", "5", "None"]


# Decontamination


def plain_leaks(text, items):
    own = decontam.TOKEN.findall((text or "").encode().lower())
    out = set()
    for item, bench in items.items():
        b = decontam.TOKEN.findall(bench.encode().lower())
        size = min(len(b), decontam.WINDOW)
        if len(b) < decontam.LEAST:
            continue
        for i in range(len(own) - size + 1):
            for j in range(len(b) - size + 1):
                # Items shorter than every mask must be there word for word.
                least = size if size < min(map(len, decontam.MASKS)) else decontam.EQUAL * size
                if sum(x == y for x, y in zip(own[i : i + size], b[j : j + size], strict=True)) >= least:
                    out.add(item)
    return out


def test_leaks(spark):
    rng = random.Random(5)
    item = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    items = {i: item(n) for i, n in enumerate([40, 25, 13, 6, 3, 60])}
    items[6] = items[1]
    rows = []
    for i in range(120):
        own = item(80)
        which = items[i % 6]
        part = list(which)
        if i % 4 == 1:  # every seventh word is another one
            part = [f"sub{k}" if k % 7 == 3 else w for k, w in enumerate(part)]
        if i % 4 != 3:
            own[20:20] = part
        rows.append((i, " ".join(own).title() + "."))
    rows += [(500, None), (501, ""), (None, " ".join(items[0])), (502, " ".join(items[0])), (502, " ".join(items[0]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(3))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(90, None), (91, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminations(docs, bench).collect()}
    want = {(i, x) for i, t in rows if i is not None for x in plain_leaks(t, {k: " ".join(w) for k, w in items.items() if k != 6})}
    assert got == want and len(got) > 60
    clean = decontam.decontaminated(docs, bench)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want} - {None}  # that row holds items[0]
    assert decontam.contaminations(docs.filter("false"), bench).collect() == [] == decontam.contaminations(docs, bench.filter("false")).collect()


def test_masks_leave_no_window_out():
    from itertools import combinations

    n = decontam.WINDOW
    for gone in combinations(range(n), n - math.ceil(decontam.EQUAL * n)):
        assert any(all(m[p - s] == "0" for p in gone if s <= p < s + len(m)) for m in decontam.MASKS for s in range(n - len(m) + 1)), gone


# Packing


def test_packing_keeps_every_token(spark, docs):
    rows = packing.packed(docs, packing.n_tokens(), shard_rows=60).collect()
    length = {r["doc_id"]: len(words(r["text"])) + 1 for r in docs.collect()}
    cover = {}
    for r in rows:
        cover.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert set(cover) == set(length)
    for i, own in cover.items():
        at = 0
        for start, n in sorted(own):
            assert start == at and n > 0
            at += n
        assert at == length[i]
    bins = {}
    for r in rows:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["slot"])
        used = 0
        for k, r in enumerate(own):
            assert (r["slot"], r["offset"]) == (k, used)
            used += r["length"]
        # Cut down to the least permitted length.
        assert own[0]["capacity"] == min(c for c in packing.CAPACITIES if c >= used)


def test_packing_is_best_fit_and_opens_the_cheapest():
    where, final = packing.pack([60, 50, 40, 30, 10, 10], [100])
    assert final == [100, 100] and where == [0, 1, 0, 1, 1, 1]
    where, final = packing.pack([30, 30, 30, 30], [32, 128])
    assert sum(map(packing.cost, final)) <= min(4 * packing.cost(32), packing.cost(128))
    assert packing.pack([], [8]) == ([], [])
    one = packing.pack([5], [8, 16])
    assert one == ([0], [8])


def test_packing_of_odd_rows(spark):
    rows = packing.packed(odd_rows(spark), packing.n_tokens()).collect()
    assert sum(r["length"] for r in rows) == 1 + 1 + 1 + 4 + 40003 + 2 * 2
    assert packing.packed(odd_rows(spark), F.lit(None)).collect() == []
    with pytest.raises(ValueError):
        packing.packed(odd_rows(spark), F.lit(1), [])


def test_every_query_is_named():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(CHECKS) <= set(QUERIES)


def test_equal_pieces_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 7)
    docs = spark.range(300).select(F.when(F.col("id") < 200, F.lit(None)).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit(10).alias("n"))
    rows = packing.packed(docs, F.col("n"), [30, 60], shard_rows=20).collect()
    assert len(rows) == 300 and sum(r["doc_id"] is None for r in rows) == 200
    sizes = [sum(r["shard"] == s for r in rows) for s in {r["shard"] for r in rows}]
    assert len(sizes) == 15 and max(sizes) < 3 * 20
    again = packing.packed(docs, F.col("n"), [30, 60], shard_rows=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_packing_places_everything_once(spark):
    """Every bin against its pieces, and no fewer bins than a plain first-fit of each shard would need by more than a tenth."""
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, rng.choice([1, 5, 17, 40, 90, 250])) for i in range(400)], "doc_id long, n int")
    caps = [32, 64, 128]
    rows = packing.packed(docs, F.col("n"), caps, shard_rows=100).collect()
    bins = {}
    for r in rows:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["slot"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        total = sum(r["length"] for r in own)
        assert {r["capacity"] for r in own} == {min(c for c in caps if c >= total)}
    covered = {}
    for r in rows:
        covered.setdefault(r["doc_id"], []).append((r["start"], r["start"] + r["length"]))
    for d in docs.collect():
        spans = sorted(covered[d["doc_id"]])
        assert spans[0][0] == 0 and spans[-1][1] == d["n"] and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))

    def plain(lengths):
        """Cost of first-fit into the largest length, cut down at the end."""
        open_ = []
        for n in lengths:
            b = next((b for b in open_ if sum(b) + n <= caps[-1]), None)
            open_.append([n]) if b is None else b.append(n)
        return sum(packing.cost(min(c for c in caps if c >= sum(b))) for b in open_)

    got = sum(packing.cost(own[0]["capacity"]) for own in bins.values())
    want = sum(plain([r["length"] for r in rows if r["shard"] == s]) for s in {r["shard"] for r in rows})
    assert got <= 1.1 * want


def test_long_runs_and_doubled_values_cost_no_more_than_their_text():
    start = time.perf_counter()
    run = credentials.scan("token=abcdefgh1 " + "a" * 1_000_000)
    assert ("assign", 0, 15) in run and ("lexed", 6, 15) in run
    doubled = "a = 'kx9Q2zPw'\n" + "a = a + a\n" * 40 + "password = a\n"
    assert credentials.lexed_spans(doubled) == [(5, 13)]
    for text in ("a=" * 200_000, "a" * 500_000 + "=b " + "x" * 300_000 + ":", ":" * 300_000 + "=" * 300_000, 'a="' * 200_000, "-" * 500_000 + "=", "a]" * 300_000 + "=", "secret" + " " * 500_000 + "= abcdef12"):
        credentials.scan(text)
    assert time.perf_counter() - start < 6


def test_names_are_read_from_their_operators():
    def literals(text):
        return [text[a:b] for a, b in credentials.lexed_spans(text)]

    secret = "hQ7x9Zk2Lm"
    for text in (
        f"db_password = '{secret}'", f'"apiKey": "{secret}"', f"token: str = '{secret}'", f"config['secret'] = \"{secret}\"", f"--auth-token={secret} --v=1",
        f"x = y = 3\nmy_pwd := {secret}", f"<password>{secret}</password>", f"k = '{secret}'\nprivate_key => k", f"part = '{secret[:5]}'\nsecret = part + '{secret[5:]}'",
        f"9password={secret}",
    ):
        assert "".join(literals(text)) == secret, text
    for text in (f"password == '{secret}'", f"password != '{secret}'", f"note = '{secret}'", "password = 'changeme'", "password = 'two words here'", f"password\" : '{secret}'", "secret = " + "x" * 500, "token = '" + "*" * 200 + "'"):
        assert literals(text) == [], text


def test_summaries_score_like_whole_literals():
    rng = random.Random(9)
    for _ in range(400):
        parts = ["".join(rng.choices("aB3- x*.<>", k=rng.randrange(0, 50))) for _ in range(rng.randrange(1, 5))]
        value = credentials.Value("")
        for p in parts:
            value += credentials.Value(p)
        whole = "".join(parts)
        assert abs(value.score() - credentials.literal_score(whole)) < 1e-12
        spaced = " " in whole.strip()
        assert value.spaced() == spaced and value.size == len(whole)
