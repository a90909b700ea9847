"""The operators as queries over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censa.llm import alignment, bpe, exact_dedup, fingerprints, language_id, license_scan, near_dedup, packing, resampling, sharding, token_files, toxicity, url_filter
from censa.llm.shared import shipped, table
from censa.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKENIZERS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function's name."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        shipped(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.sharded(table(spark, folder, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), TOKENIZER)


@query
def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(table(spark, folder, "documents"))


@query
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), TOKENIZER, path)
    return token_files.read(spark, path, ids=False)


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), TOKENIZER)


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scanned(table(spark, folder, "documents"))


@query
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judged(table(spark, folder, "pages"), rules)


@query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(table(spark, folder, "documents"))


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.scored(documents, toxicity.trained(documents, table(spark, folder, "labels")))


@query
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(table(spark, folder, "documents"))


@query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.alignments(table(spark, folder, "documents"), *TOKENIZERS)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return language_id.identified(documents, language_id.learned(documents)).select("doc_id", "held_out", "lang_pred", "score")


@query
def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op8_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256 FROM d
"""

#: The tables hold no canonical link or refresh (checked here), so every url stands alone.
ORACLES["op6_url_filter"] = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages WHERE NOT regexp_matches(coalesce(html, ''), '(?i)rel\s*=\s*["'']?canonical|http-equiv\s*=\s*["'']?refresh')
), r(rhost, rpath, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(action, length(rhost || rpath)) AS action
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN best USING (page_id)
"""

#: CRC-32 by its table, byte by byte, over the distinct features.
ORACLES["op13_resampling"] = r"""
WITH steps AS (
  SELECT list(c ORDER BY v) AS t FROM (
    SELECT v, list_reduce(list_prepend(v, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM (SELECT unnest(range(256)) AS v)
  )
), rows_ AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT 's' AS side, id, text FROM rows_ UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark)
), f AS (
  SELECT side, id, unnest(words || list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) AS feature FROM w
), counted AS (SELECT side, id, feature, count(*) AS n FROM f GROUP BY ALL),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) // 2 + 1), lambda k: ('0x' || h[2 * k - 1 : 2 * k])::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counted)), steps
), b AS (SELECT side, bucket, sum(n)::DOUBLE AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL),
totals AS (SELECT coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM b),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(sum(n) FILTER (side = 't'), 0) + 1) * (any_value(totals.s) + 10000) / ((coalesce(sum(n) FILTER (side = 's'), 0) + 1) * (any_value(totals.t) + 10000))))::BIGINT AS gain
  FROM b, totals GROUP BY bucket
), weights AS (
  SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 's' GROUP BY id
), scored AS (
  SELECT id, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM rows_ JOIN (SELECT id, words FROM w WHERE side = 's') USING (id) LEFT JOIN weights USING (id)
), ranked AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (id)
"""
