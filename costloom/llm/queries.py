"""The corpus queries, each next to the SQL it must agree with where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import credentials, decontam, hosts, infill, langid, licenses, lm, negatives, packing, quality, simhash, toxicity, warc
from .common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def wrap(fn: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(lambda t: table(spark, sf_dir, t))

        run.__name__ = name
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = check.strip()
        return fn

    return wrap


@query("op1_best_fit_packing")
def _packing(t):
    return packing.packed(t("documents"), packing.n_tokens())


@query("op2_lm_scoring")
def _scores(t):
    return lm.scores(t("documents"))


@query("op3_benchmark_decontamination")
def _decontam(t):
    return decontam.contaminations(t("documents"), t("benchmark"))


@query("op4_secret_scan")
def _secrets(t):
    return credentials.digest(t("documents"))


@query(
    "op5_warc",
    r"""
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
    ), coded AS (
      SELECT p.page_id, p.payload_bytes, p.h,
        string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (5 * c + 1)::INT, 5))::BIGINT >> (15 - 5 * d)::INT) & 31)::INT + 1, 1), '' ORDER BY c, d) AS payload_digest
      FROM p, range(8) a(c), range(4) b(d) GROUP BY ALL
    ), firsts AS (
      SELECT h, min(page_id) AS f FROM p GROUP BY h
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id > f THEN f END AS refers_to
    FROM coded JOIN firsts USING (h)
    """,
)
def _warc(t):
    return warc.round_trip(t("pages"))


@query("op6_simhash_near_duplicates")
def _simhash(t):
    return simhash.digest(t("documents"))


@query("op7_host_quality_rules")
def _hosts(t):
    return hosts.digest(t("documents"))


@query("op8_license_scan")
def _licenses(t):
    return licenses.digest(t("documents"))


@query("op9_toxicity")
def _toxicity(t):
    return toxicity.predict_held_out(t("documents"), t("labels"))


@query("op10_language_id")
def _langid(t):
    return langid.predict_held_out(t("documents"))


@query("op11_quality")
def _quality(t):
    return quality.predict_held_out(t("documents"), t("labels"))


@query(
    "op12_hard_negatives",
    """
    WITH sound AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
      FROM sound a JOIN sound r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
    ), positive AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
      (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank,
      s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
      AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
    QUALIFY rank <= 5
    """,
)
def _negatives(t):
    return negatives.hard_negatives(t("embeddings"))


@query(
    "op13_fill_in_middle",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || doc_id) AS h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t
      FROM documents
    ), r AS (
      SELECT doc_id, x, t, len(t) AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS c2,
        ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4
      FROM d
    ), f AS (
      SELECT doc_id, x, n, array_to_string(t[1:least(c1, c2)], '') AS p, array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
        array_to_string(t[greatest(c1, c2) + 1:], '') AS s,
        CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
      FROM r
    )
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(x) AS restored_sha256
    FROM f
    """,
)
def _infill(t):
    return infill.digest(t("documents"))
