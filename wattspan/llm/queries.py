"""Registered queries of the numbered operators, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspan.llm import (
    decontaminate, embeddings, licenses, line_dedup, near_dups, packing, phrases, quality_rules, records, substrings, token_counts,
    tries, url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query("op2_token_counts")
def op2(spark, sf):
    return token_counts.token_counts(documents(spark, sf))


@query("op4_token_records")
def op4(spark, sf):
    return records.round_trip(documents(spark, sf)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_packing")
def op8(spark, sf):
    return packing.pack(documents(spark, sf)).drop("ids")


@query("op10_line_dedup", """
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, i, line, coalesce(doc_id <> keeper, FALSE) AS dropped FROM lines LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op10(spark, sf):
    out = line_dedup.dedup_lines(documents(spark, sf))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op6_near_dups", r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN sizes ON a = sizes.doc_id GROUP BY a
""")
def op6(spark, sf):
    return near_dups.near_duplicates(documents(spark, sf))


@query("op1_suffix_dedup")
def op1(spark, sf):
    out = substrings.remove_repeats(documents(spark, sf))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_url_filters", r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages
), rules(action, rule, h, p) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')
), fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
), others AS (
  SELECT page_id, host, path, regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '://([^/?#]*[.-])?(casino[.-]|bets[.-]|cheap-pills\.)|[/.]login([/?#.]|$)|[?&]session=[0-9a-f]+') AS bad FROM parts
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM others LEFT JOIN fits USING (page_id)
""")
def op3(spark, sf):
    return url_filters.judge_urls(spark.read.parquet(f"{sf}/pages.parquet"))


@query("op5_quality_rules")
def op5(spark, sf):
    return quality_rules.judge_quality(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query("op9_decontamination", r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark
), tokens AS (
  SELECT kind, id, regexp_extract_all(text, '\p{L}+|[0-9]+(?:[.,][0-9]+)*|[%$€£°]') AS t FROM texts
), forms AS (
  SELECT *, list_transform(t, lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN '<num>'
    WHEN regexp_matches(x, '^\p{Lu}\p{Ll}') THEN '<name>'
    WHEN regexp_matches(x, '^(?:[%$€£°]|mm|cm|m|km|mg|g|kg|ml|l|s|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|meters?|metres?|miles?|feet|inch(?:es)?|liters?|litres?|grams?|kilograms?|pounds?|dollars?|euros?|cents?)$') THEN '<unit>'
    ELSE lower(x) END) AS f FROM tokens
), windows AS (
  SELECT kind, id, p, f[p:p + 7] AS w, t[p:p + 7] AS v
  FROM (SELECT *, unnest(range(1, len(t) - 6)) AS p FROM forms WHERE len(t) >= 8)
), items AS (
  SELECT *, count(*) OVER (PARTITION BY id) AS many FROM windows
  WHERE kind = 'b' AND len(list_filter(w, lambda x: x[1] <> '<')) >= 4
), found AS MATERIALIZED (
  SELECT d.id AS doc, i.id AS item, d.p - i.p AS gap, i.p AS ipos, i.v AS iv, d.v AS dv, many, i.w AS w
  FROM windows d JOIN items i ON d.kind = 'd' AND d.w = i.w
), counts AS (
  SELECT doc, item, gap, count(DISTINCT ipos) AS n, max(many) AS many FROM found GROUP BY ALL
  HAVING count(DISTINCT ipos) >= least(6, max(many))
), slots AS (
  SELECT DISTINCT doc, item, gap, ipos + k AS slot, iv[k] AS i, dv[k] AS d
  FROM (SELECT *, unnest(range(1, 9)) AS k FROM found) WHERE w[k][1] = '<'
), pairs AS (SELECT doc, item, gap, i, d, count(*) AS n FROM slots GROUP BY ALL
), agreed AS (
  SELECT doc, item, gap, sum(s) AS n_slots, sum(m) AS agree, sum(c) AS changed
  FROM (SELECT doc, item, gap, i, sum(n) AS s, max(n) AS m, sum(CASE WHEN i <> d THEN n ELSE 0 END) AS c
    FROM pairs GROUP BY ALL) GROUP BY ALL
), good AS (
  SELECT doc, item, n, coalesce(n_slots, 0) AS n_slots, coalesce(changed, 0) AS changed
  FROM counts LEFT JOIN agreed USING (doc, item, gap) WHERE coalesce(agree, 0) >= 0.8 * coalesce(n_slots, 0)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY n DESC, changed, n_slots DESC) AS k FROM good
)
SELECT doc AS doc_id, item AS item_id, n AS n_windows, n_slots::BIGINT AS n_slots, changed::BIGINT AS n_changed
FROM ranked WHERE k = 1
""")
def op9(spark, sf):
    return decontaminate.hits(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query("op7_license_scans")
def op7(spark, sf):
    return licenses.scan_licenses(documents(spark, sf))


@query("op11_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
), words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30
), found AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM grams WHERE k > 1
), cuts AS (
  SELECT lang, k, g, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM found)
), scored AS (
  SELECT c.lang, c.g, c.a, j, p.f AS l, q.f AS r, ((2000000::HUGEINT * c.a) // (p.f::HUGEINT + q.f))::BIGINT AS score
  FROM cuts c JOIN grams p ON c.lang = p.lang AND c.x = p.g AND p.k = c.j
  JOIN grams q ON c.lang = q.lang AND c.y = q.g AND q.k = c.k - c.j
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM found, (VALUES (2), (3)) t(m) WHERE m < k) GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.g) AS rank
  FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.g = i.g WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT r.lang, rank, g AS phrase, a, l, r, n, score FROM ranked r JOIN totals USING (lang) WHERE rank <= 2000
""")
def op11(spark, sf):
    return phrases.collocations(documents(spark, sf))


@query("op12_near_vectors", """
WITH RECURSIVE rows AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), usable AS MATERIALIZED (
  SELECT * FROM rows WHERE label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT x.i AS a, y.i AS b FROM usable x JOIN usable y ON x.label = y.label AND x.i <> y.i AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), reach AS (SELECT i AS a, i AS b FROM rows UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN rows ON b = i GROUP BY a
), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, CASE WHEN vec_id IS NOT NULL THEN component_id END AS component_id,
  coalesce(vec_id = component_id, FALSE) AS kept
FROM rows JOIN least ON i = least.a LEFT JOIN degrees ON i = degrees.a
""")
def op12(spark, sf):
    return embeddings.near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op13_prefix_trie", """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))),
    4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), mixed AS (
  SELECT s.conv_id, i, t FROM sizes s JOIN turns b ON b.conv_id = s.base AND i < h
  UNION ALL SELECT s.conv_id, i, t FROM sizes s JOIN turns o ON o.conv_id = s.conv_id AND i >= h
), whole AS MATERIALIZED (
  SELECT s.conv_id, coalesce(list(t ORDER BY i) FILTER (WHERE t IS NOT NULL), []) AS ts
  FROM sizes s LEFT JOIN mixed m ON m.conv_id = s.conv_id GROUP BY s.conv_id
), members AS MATERIALIZED (
  SELECT conv_id, d AS depth, ts[1:d] AS prefix, len(ts) = d AS ends FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM whole)
), nodes AS MATERIALIZED (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE strlen(prefix[depth].text) END AS saved
  FROM members GROUP BY prefix, depth
), children AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS c FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (SELECT n.*, coalesce(c, 0) AS c FROM nodes n LEFT JOIN children USING (prefix)
), above AS (
  SELECT prefix[1:d] AS prefix, sum(saved) AS saved, count(*) FILTER (WHERE c = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.c AS n_children, a.leaves AS n_leaves,
  a.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN above a ON a.prefix = n.prefix LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
""")
def op13(spark, sf):
    return tries.conversation_trie(spark.read.parquet(f"{sf}/conversations.parquet"))
