"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.centroids import bisector_clusters
from placeweave.llm.gif import media_digests
from placeweave.llm.jaccard_join import ngram_jaccard_join
from placeweave.llm.language_id import held_out, identify, learn
from placeweave.llm.line_dedup import dedup_lines
from placeweave.llm.main_text import extract_main_text
from placeweave.llm.mixing import DIMENSIONS, POWERS, calibrated_sample, mix_sources, sampled, shares
from placeweave.llm.packing import pack_documents
from placeweave.llm.resampling import importance_resample
from placeweave.llm.sharding import kd_shards
from placeweave.llm.token_counts import token_counts
from placeweave.llm.topk_search import voronoi_knn_join
from placeweave.llm.url_filters import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


#: host, path, verdict
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLE_SQL["op3_url_filters"] = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
rest AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest)
SELECT page_id, host, path,
  arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
  coalesce(arg_max(rule_verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY page_id, host, path
"""


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"), shards=24)


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = calibrated_sample(table(spark, sf_dir, "documents"))
    return mixed.selectExpr(
        "doc_id", "source", "lang", "topic", "n_tokens", "round(weight, 6) as weight", "round(probability, 6) as probability", "kept"
    )


def _cells_sql() -> list[str]:
    steps = [
        """docs AS (SELECT doc_id, source AS s, lang AS l, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty' WHEN contains(text, ' | ') THEN 'table'
       WHEN contains(text, '://') OR contains(text, '@') THEN 'web' ELSE 'prose' END AS topic,
  CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) + 1 AS n_tokens FROM documents)""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL)",
    ]
    for d in DIMENSIONS:
        steps.append(f"goal_{d} AS MATERIALIZED (SELECT {d}, pow(sum(tokens), {POWERS[d]}) / sum(pow(sum(tokens), {POWERS[d]})) OVER () AS share FROM cells GROUP BY {d})")
    return steps


def _mixing_sql(keep: float = 0.8, rounds: int = 40, seed: int = 17) -> str:
    """Raking written out pass by pass, with more rounds than it takes to settle."""
    steps = _cells_sql()
    last = "(SELECT *, tokens AS weight, sum(tokens) OVER () AS total FROM cells)"
    for k in range(rounds):
        for d in DIMENSIONS:
            name = f"pass_{k}_{d}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT w.source, w.lang, w.topic, tokens, total, weight * share * total / sum(weight) OVER (PARTITION BY w.{d}) AS weight "
                f"FROM {last} w JOIN goal_{d} g ON w.{d} = g.{d})"
            )
            last = name
    draw = f"CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0"
    return f"""WITH {", ".join(steps)}, scaled AS (SELECT *, least({keep}, 1 / max(weight / tokens) OVER ()) AS scale FROM {last})
SELECT doc_id, s AS source, l AS lang, d.topic AS topic, n_tokens, round(p.weight / tokens, 6) AS weight,
  round(least(1.0, scale * (p.weight / tokens)), 6) AS probability, {draw} < scale * (p.weight / tokens) AS kept
FROM docs d JOIN scaled p ON d.source = p.source AND d.lang = p.lang AND d.topic = p.topic"""


ORACLE_SQL["op10_mixing"] = _mixing_sql()


@query
def op10_mixing_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and expected shares of each source, language and topic."""
    found = shares(calibrated_sample(table(spark, sf_dir, "documents")))
    return found.select("dimension", "value", F.round("target", 6).alias("target"), F.round("expected", 6).alias("expected"))


#: What is expected are the targets: no raking on this side.
ORACLE_SQL["op10_mixing_shares"] = (
    "WITH "
    + ", ".join(_cells_sql())
    + " UNION ALL ".join(f" SELECT '{d}' AS dimension, {d} AS value, round(share, 6) AS target, round(share, 6) AS expected FROM goal_{d}" for d in DIMENSIONS)
)


@query
def op10_mixing_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample itself, with the copies that op10_mixing's columns cannot show."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return sampled(mixed).select("doc_id", "copy", "source", "lang", "topic", "n_tokens")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out("doc_id")))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op8_media_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(table(spark, sf_dir, "documents"))


@query
def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn_join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLE_SQL["op9_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


@query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisector_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds written out: every distance, the least of each vector, floors of means."""
    far = "CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS c, x FROM v ORDER BY sha256('2:' || vec_id) NULLS LAST, x LIMIT {k})",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT i, any_value(vec_id) AS vec_id, min([{far}, c.c]) AS best FROM v, c{n} c GROUP BY i)")
        if n < rounds:
            steps.append(
                f"""s{n} AS MATERIALIZED (SELECT best[2] AS c, p, sum(v.x[p]) AS s, count(*) AS n FROM a{n} JOIN v USING (i), range(1, 65) AS r(p) GROUP BY ALL)"""
            )
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS x FROM s{n} GROUP BY c) m ON c.c = m.c)"""
            )
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.best[2] = c.c"""


ORACLE_SQL["op11_centroid_clusters"] = _clusters_sql()


@query
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


#: By patterns instead of events, for pages with one marked article of headings and paragraphs.
ORACLE_SQL["op12_main_text"] = r"""
WITH inner_html AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '') AS a FROM pages),
parts AS (SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'), lambda x:
  trim(regexp_replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS blocks FROM inner_html),
told AS (SELECT page_id, url, regexp_replace(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)), '&amp($|\n)', '&\1') AS text FROM parts)
SELECT page_id, url, text, length(text) AS n_chars FROM told
"""


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 byte by byte over a table that is made bit by bit.
ORACLE_SQL["op13_resampling"] = r"""
WITH bits AS (SELECT list(list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS crc FROM range(256) AS r(n)),
d AS MATERIALIZED (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS MATERIALIZED (SELECT i, unnest(w) AS w FROM d),
dcount AS (SELECT w, count(*) AS n, 0 AS m FROM dw GROUP BY w), tcount AS (SELECT w, 0 AS n, count(*) AS m FROM t GROUP BY w),
words AS MATERIALIZED (SELECT w, sum(n) AS n, sum(m) AS m, hex(encode(w)) AS h FROM (FROM dcount UNION ALL FROM tcount) GROUP BY w),
bucketed AS MATERIALIZED (SELECT w, n, m, xor(list_reduce(list_transform(range(length(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)),
  lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM words, bits),
totals AS (SELECT bucket, sum(n) AS s, sum(m) AS t, sum(sum(n)) OVER () AS bs, sum(sum(m)) OVER () AS bt FROM bucketed GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (bs + 10000)::DOUBLE / ((s + 1)::DOUBLE * (bt + 10000)::DOUBLE))) AS BIGINT) AS gain FROM totals),
sums AS (SELECT i, sum(gain) AS g FROM dw JOIN bucketed USING (w) JOIN gains USING (bucket) GROUP BY i),
weights AS (SELECT d.i, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(CASE WHEN len(w) = 0 THEN 0 ELSE (g - ((g % len(w)) + len(w)) % len(w)) // len(w) END AS BIGINT) AS weight,
  CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN sums ON d.i = sums.i),
scores AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weights),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM ranked
"""
