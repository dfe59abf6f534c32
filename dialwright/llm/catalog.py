"""Queries of the operators on the given tables, and SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dialwright.llm import embeddings, filter_audit, mixing, mixture_packing, packing, prefix_trie, quality, repeats, simhash, token_counts, token_files, url_filter, warc
from dialwright.llm.common import table
from dialwright.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model, budget=4096)


_MIX_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
totals AS (SELECT count(*) AS k, sum(n) AS n FROM sizes),
rates AS (SELECT source, 1.0 / k * totals.n::DOUBLE / sizes.n AS rate FROM sizes, totals),
terms AS (
  SELECT source, i, exp(-rate + i * ln(rate) - lgamma(i + 1.0)) AS p
  FROM rates, generate_series(0, (SELECT CAST(ceil(max(rate) + 12 * sqrt(max(rate)) + 24) AS BIGINT) FROM rates)) g(i)
),
cdf AS (SELECT source, i, sum(p) OVER (PARTITION BY source ORDER BY i) AS c FROM terms),
named AS (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS name FROM documents),
draws AS (
  SELECT *, ('0x' || substr(md5('7:' || name), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM named
),
counted AS (
  SELECT d.doc_id, count(*) AS n FROM draws d JOIN cdf c ON c.source = d.source AND c.c <= d.u GROUP BY d.doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, j::INT AS copy, md5('8:' || d.name || ':' || j) AS shuffle_key
FROM named d JOIN counted USING (doc_id), generate_series(0, n - 1) s(j)
"""


@query("op2_sorted_projections")
def op2_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    scored = quality.score_documents(table(spark, sf_dir, "documents"), trusted)
    return scored.drop("text_hash")


@query("op4_poisson_mixing", _MIX_SQL)
def op4_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=None, seed=7)


@query("op5_sum_of_squares_packing")
def op5_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0
    )
    return packed.drop("row_no")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]

_URL_SQL = r"""
WITH rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rested AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
hosted AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rested),
parts AS (
  SELECT page_id, url,
    translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))) AS kept
  FROM hosted
),
named AS (
  SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical
  FROM parts
),
listed AS (SELECT canonical FROM named WHERE canonical <> '' GROUP BY canonical HAVING count(*) > 1),
fitting AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(r.verdict, length(h || p)) AS ruled
  FROM named, rules r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT n.page_id, n.host, n.path, f.rule,
  coalesce(f.ruled, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN fitting f USING (page_id) LEFT JOIN listed l ON l.canonical = n.canonical
"""


@query("op6_url_filter", _URL_SQL)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, URL_RULES, url_filter.repeated_urls(pages))


@query("op7_suffix_arrays")
def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(table(spark, sf_dir, "documents"), size=50).drop("spans")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=3, shingle_words=3)


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_file_digest(table(spark, sf_dir, "documents"), path, end_id=0)


@query("op10_merkle_audit")
def op10_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One record in about 500 of the second replica has a bit turned, to be found.
    pages = table(spark, sf_dir, "pages")
    return warc.fixity_audit(pages, shared_dir(spark, "warc"), damage_every=500)


@query("op11_mixture_packing")
def op11_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return mixture_packing.pack_mixture(table(spark, sf_dir, "documents"), path, capacity=4096, end_id=2)


_AUDIT_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
flags AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM texts JOIN firsts USING (t) LEFT JOIN flags USING (doc_id)
),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
prefixes AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || letter FROM prefixes, letters WHERE strpos(filter_order, letter) = 0
),
steps AS (
  SELECT filter_order, step::INT AS step, letter, bit,
    (SELECT coalesce(sum(l.bit), 0)::INT FROM letters l WHERE strpos(substr(filter_order, 1, step - 1), l.letter) > 0) AS applied
  FROM prefixes, generate_series(1, 5) g(step), letters
  WHERE length(filter_order) = 5 AND substr(filter_order, step, 1) = letter
),
counts AS (
  SELECT part, filter_order, step, letter,
    count(*) FILTER (mask & applied = 0 AND mask & bit = 0) AS kept,
    count(*) FILTER (mask & applied = 0 AND mask & bit <> 0) AS removed,
    count(*) FILTER (mask & applied <> 0 AND mask & bit <> 0) AS redundant,
    count(*) FILTER (mask = bit) AS unique_fails,
    count(*) FILTER (mask & applied = 0 AND mask & bit <> 0 AND good) AS good_lost,
    count(*) FILTER (mask & applied = 0 AND mask & bit <> 0 AND toxic) AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counts
"""


@query("op12_filter_audit", _AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_TRIE_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
turns AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said, turn,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list(said ORDER BY turn NULLS FIRST, digest) AS said,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT) AS digits
  FROM turns GROUP BY conv_id
),
hashed AS (
  SELECT conv_id, said, xor(list_reduce(list_prepend(4294967295, digits),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 4 AS h FROM own, crc
),
rebuilt AS (
  SELECT a.conv_id, coalesce(list_slice(b.said, 1, a.h), []) || coalesce(list_slice(a.said, a.h + 1, len(a.said)), []) AS said
  FROM hashed a LEFT JOIN hashed b ON b.conv_id = a.conv_id - a.conv_id % 20
),
members AS (
  SELECT conv_id, d AS depth, list_slice(said, 1, d) AS path, len(said) = d AS ends FROM rebuilt, range(len(said) + 1) r(d)
),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth
),
valued AS (
  SELECT *, (n_convs - 1) * (CASE WHEN depth = 0 THEN 0
    ELSE len(regexp_extract_all(path[depth].text, '[^ 	-
]+')) END) AS saved FROM nodes
),
families AS (
  SELECT p.conv_id, p.depth, count(c.path) AS n_children FROM nodes p
  LEFT JOIN nodes c ON c.depth = p.depth + 1 AND list_slice(c.path, 1, p.depth) = p.path GROUP BY ALL
),
ancestors AS (
  SELECT list_slice(v.path, 1, d) AS path, d AS depth, v.saved, f.n_children
  FROM valued v JOIN families f ON f.conv_id = v.conv_id AND f.depth = v.depth, range(v.depth + 1) r(d)
),
subtrees AS (
  SELECT path, depth, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM ancestors GROUP BY path, depth
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, f.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.depth = n.depth AND s.path = n.path
JOIN families f ON f.conv_id = n.conv_id AND f.depth = n.depth
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)
"""


@query("op13_prefix_trie", _TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
