"""The queries of the operators, and the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import bpe, decontaminate, exact_dedup, langid, minhash, negatives, runs, secrets, sharding, simhash, token_counts, toxicity, url_graph
from weirflow.llm.common import prepared, remainder, table, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op1_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
              coalesce(doc_id = max(doc_id) OVER w, max(doc_id) OVER w IS NULL) AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text_sha256", F.sha2(texts("text"), 256))
    return exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op7_language_id")
def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(langid.learnable(docs))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op8_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_sharding")
def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


@query("op5_bpe")
def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_token_counts")
def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(table(spark, sf_dir, "documents"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


# The ranks in the oracle are sums over walks of up to 250 steps, of which those left out weigh 2e-18.
@query(
    "op2_url_filter",
    rf"""
    WITH RECURSIVE a AS (SELECT page_id, html, translate(CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1) ELSE '' END, {_LETTERS}) AS host,
        CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) ELSE '' END AS path FROM pages),
    rules(rule, rh, rp, rv) AS (VALUES {", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in url_graph.RULES)}),
    p AS (SELECT host, path, count(*) AS n FROM a GROUP BY ALL),
    j AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(rv, length(rule)) AS rv FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL),
    votes AS (SELECT host, rv, sum(n) AS n FROM p JOIN j USING (host, path) WHERE host <> '' GROUP BY ALL),
    seed0 AS (SELECT CASE rv WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, n / sum(n) OVER (PARTITION BY host) AS w FROM votes),
    seed AS (SELECT kind, host, w / sum(w) OVER (PARTITION BY kind) AS r FROM seed0),
    links AS (SELECT DISTINCT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '(?i)(?:href|src)\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)', 1)), {_LETTERS}) AS dst FROM a),
    hosts AS (SELECT host AS h FROM a UNION SELECT dst FROM links),
    kin AS (SELECT h AS src, regexp_replace(h, '^[^.]*\.', '') AS dst FROM hosts WHERE h LIKE '%.%.%'),
    edges AS (SELECT DISTINCT src, dst FROM (SELECT * FROM links UNION ALL SELECT * FROM kin UNION ALL SELECT dst, src FROM kin) WHERE src <> dst AND src <> '' AND dst <> ''),
    steps AS (SELECT 'trust' AS kind, src AS host, dst AS onward, 0.85::DOUBLE / count(*) OVER (PARTITION BY src) AS w FROM edges UNION ALL SELECT 'distrust', dst, src, 0.85::DOUBLE / count(*) OVER (PARTITION BY dst) FROM edges),
    walk(k, kind, host, r) AS (
      SELECT 0, kind, host, CAST(r AS DOUBLE) FROM seed
      UNION ALL SELECT k + 1, kind, onward, sum(r * w) FROM walk JOIN steps USING (kind, host) WHERE k < 250 GROUP BY k, kind, onward),
    ranks AS (SELECT kind, host, sum(r) AS r FROM walk GROUP BY ALL),
    shares AS (SELECT host, coalesce(sum(r) FILTER (kind = 'trust') / (SELECT sum(r) FROM ranks WHERE kind = 'trust'), 0) AS t, coalesce(sum(r) FILTER (kind = 'distrust') / (SELECT sum(r) FROM ranks WHERE kind = 'distrust'), 0) AS d FROM ranks GROUP BY host)
    SELECT page_id, a.host, a.path, rule, coalesce(rv, CASE WHEN d > 0 AND d * 1.000001 >= t THEN 'block' ELSE 'allow' END) AS verdict
    FROM a LEFT JOIN j USING (host, path) LEFT JOIN shares ON shares.host = a.host""",
)
def url_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_graph.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op3_decontaminate")
def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_secret_scan")
def secret_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query("op11_minhash")
def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(table(spark, sf_dir, "documents"))


@query("op12_hard_negatives")
def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mining_report(table(spark, sf_dir, "embeddings"))


@query("op13_periodic_runs")
def periodic_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(table(spark, sf_dir, "documents"))
