"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import binpack, bpe, langid, lm, neardup, negatives, packing, quality, repeats, secrets, topk, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op10_host_quality",
    r"""
    WITH d AS (
      SELECT doc_id, source, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM documents),
    win AS (
      SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)),
    hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
    cov AS (
      SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM hit) GROUP BY doc_id),
    m AS (
      SELECT d.doc_id, source, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN cov USING (doc_id)),
    f AS (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 8 * n_words OR 2 * n_dup_lines > n_words AS any_failed
      FROM m),
    h AS (SELECT source, count(*) AS n, count(*) FILTER (any_failed) AS k FROM f GROUP BY source),
    p AS (SELECT sum(k) / sum(n) AS mean, var_samp(k / n) AS v FROM h),
    q AS (
      SELECT mean, CASE WHEN v > 0 AND mean * (1 - mean) / v - 1 > 0 THEN mean * (1 - mean) / v - 1 ELSE 10 END AS weight FROM p),
    r AS (SELECT source, (k + mean * weight) / (n + weight) < 0.5 AS ok FROM h, q)
    SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
    FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.host_quality(_table(spark, sf_dir, "documents")).drop("host_rate")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        "doc_id", *[count(k) for k in base],
        F.sha2(listed(F.filter("found", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = langid.in_fold("doc_id", 4, 2)
    model = langid.train(docs.where(~held_out), "doc_id", "text", "lang")
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.held_out_scores(docs, labels)


@query(
    "op7_top_k",
    """
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
    SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 5
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query("op6_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(_table(spark, sf_dir, "documents"))


@query("op3_lm_score")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs, order=3))


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, a.l = c.l AS same, list_inner_product(a.e, c.e)::BIGINT AS score
      FROM v a JOIN v c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id,
      row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
      n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON p.a = n.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    QUALIFY rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@query("op12_best_fit_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binpack.pack_whole(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
