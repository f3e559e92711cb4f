"""The dealt operators applied to their whole tables, registered by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricecast.llm import bpe, hilbert, labelled, line_dedup, mixing, prefix_trie, quality, ranked_search, simhash, substring_dedup, syncmers, token_counts, toxicity, url_filter
from pricecast.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@_query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held = labelled.remainder("doc_id", 5) == 0
    model = quality.fit(docs, labels, ~held)
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held = labelled.remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, labels, ~held)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@_query
def op2_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.against_edited_and_next(table(spark, folder, "documents"))


@_query
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = tokenizer.encode(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "ids")
    return tokenizer.decode(encoded).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


RULES = [
    url_filter.host_rule("block", "net", "/"),
    url_filter.host_rule("allow", "example.net", "/en/"),
    url_filter.host_rule("block", "example.com", "/de/"),
    url_filter.host_rule("allow", "org", "/fr/"),
]


@_query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


_GENERAL = "|".join(r.name for r in url_filter.GENERAL)
ORACLE["op5_url_filter"] = f"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '{url_filter.SPLIT_URL}', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{url_filter.SPLIT_URL}', 2) AS path
  FROM pages),
r(h, s, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
j AS (
  SELECT p.*, (SELECT max_by(h || s, length(h || s)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)) AS rule
  FROM p)
SELECT page_id, host, path, rule,
       coalesce((SELECT v FROM r WHERE h || s = rule),
                CASE WHEN regexp_matches(host || path, '(^|[^A-Za-z0-9])({_GENERAL})([^A-Za-z0-9]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM j
"""

#: Shares of expected tokens by language that the mixing query and the pipeline aim at.
WEIGHTS = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}


@_query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    ready = mixing.with_posteriors(docs, table(spark, folder, "labels"), list(WEIGHTS))
    fitted = mixing.fit_rates(ready, WEIGHTS)
    return ready.select(
        "doc_id",
        F.col("_n").cast("long").alias("n_tokens"),
        *[F.col("_p")[j].alias(f"share_{d}") for j, d in enumerate(WEIGHTS)],
        mixing.rate_column(fitted.steps).alias("rate"),
        F.lit(fitted.converged).alias("converged"),
    )


@_query
def op9_hilbert(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert.nearest(table(spark, folder, "embeddings"))


@_query
def op3_substring(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


@_query
def op4_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.by_document(table(spark, folder, "documents").select("doc_id", "text"))


#: Texts of more tokens are marked by op12_token_counts.
TOKEN_LIMIT = 4096


@_query
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return counted.select("doc_id", n_bytes, "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@_query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, folder, "conversations")))


ORACLE["op13_prefix_trie"] = """
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
crc(conv_id, left_over, step, v) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 8, CAST(4294967295 AS BIGINT) FROM own
  UNION ALL
  SELECT conv_id, CASE WHEN step = 8 THEN left_over[2:] ELSE left_over END, CASE WHEN step = 8 THEN 1 ELSE step + 1 END,
    CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END
  FROM (SELECT *, CASE WHEN step = 8 THEN xor(v, CAST(ascii(left_over) AS BIGINT)) ELSE v END AS b FROM crc WHERE step < 8 OR left_over <> '')),
h AS (SELECT conv_id, CAST(xor(v, 4294967295) % 4 AS BIGINT) AS h FROM crc WHERE step = 8 AND left_over = ''),
seq AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h.h], o.turns[h.h + 1:]) AS s
  FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
pre AS (SELECT conv_id, len(s) AS n, unnest(range(0, len(s) + 1)) AS d, s FROM seq),
node AS (
  SELECT s[1:d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM pre GROUP BY s[1:d], d),
up AS (
  SELECT c.*, u.conv_id AS parent_conv_id,
    CASE WHEN c.depth = 0 THEN 0 ELSE (c.n_convs - 1) * len(regexp_extract_all(c.p[c.depth].text, '[^\\x20\\x09-\\x0D]+')) END AS own_saved
  FROM node c LEFT JOIN node u ON u.depth = c.depth - 1 AND u.p = c.p[1:c.depth - 1]),
kids AS (SELECT u.p, count(c.p) AS n_children FROM node u LEFT JOIN node c ON c.depth = u.depth + 1 AND c.p[1:u.depth] = u.p GROUP BY u.p),
below AS (
  SELECT up.p[1:a.d] AS p, sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own_saved) AS saved_tokens
  FROM up JOIN kids k ON k.p = up.p, unnest(range(0, up.depth + 1)) a(d) GROUP BY up.p[1:a.d])
SELECT up.conv_id, CAST(up.depth AS BIGINT) AS depth, up.parent_conv_id, up.n_convs, k.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, up.ends_sha256
FROM up JOIN kids k ON k.p = up.p JOIN below b ON b.p = up.p
"""


@_query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.Searcher(table(spark, folder, "documents")).search(table(spark, folder, "benchmark"))


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE["op11_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
m AS (SELECT k, doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, total WHERE len(terms) > 0),
tf AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) GROUP BY k, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, total GROUP BY term, n_docs),
i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark),
asked AS (SELECT q, item_id, term, count(*) AS repeats FROM (SELECT q, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
scored AS (
  SELECT q, item_id, m.doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY q, item_id, k, m.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
