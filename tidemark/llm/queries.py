"""The operators of this package over the whole test tables, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    chat,
    embedding_dedup,
    fill_middle,
    filter_audit,
    langid,
    minhash,
    nearest,
    packing,
    secret_scan,
    suffix_dedup,
    url_filter,
    warc,
)
from tidemark.llm.rows import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# The list of the URL query.
URL_RULES = (
    url_filter.Rule.parse("allow", "org/"),
    url_filter.Rule.parse("block", "example.org/es/"),
    url_filter.Rule.parse("block", "example.org/en/1"),
    url_filter.Rule.parse("allow", "com/fr/"),
    url_filter.Rule.parse("block", "com/de/"),
)
# The added conversation of the chat query.
ADDED_TURNS = "VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), VOCABULARY)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(f"SELECT * FROM {ADDED_TURNS} AS t(conv_id, turn, role, text)")
    return chat.digest(chat.format_chat(rows.unionByName(added)))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(documents.where(~langid.held_out()))
    predicted = langid.predict(documents, model)
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_bpe": op2_bpe,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_packing": op5_packing,
    "op6_url_filter": op6_url_filter,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_language_id": op10_language_id,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_warc_archive": op12_warc_archive,
    "op13_filter_audit": op13_filter_audit,
}

_HOST_AND_REST = """
SELECT page_id,
       CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^?#]*)', 1)
            ELSE '' END AS rest
FROM pages"""

_URL_FILTER = f"""
WITH cut AS ({_HOST_AND_REST}),
parts AS (
  SELECT page_id,
         translate(CASE WHEN contains(rest, '/') THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM cut),
judged AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""


def _secret_sql() -> str:
    """Matches and the stretches between them give the offsets; the rules are those of the operator."""
    spans = []
    for order, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("{8,}", "+") if rule.kind == "hex" else rule.pattern
        quoted = "'" + pattern.replace("'", "''") + "'"
        flags = "'i'" if rule.ignore_case else "'c'"
        tail = f"regexp_extract(m, {quoted}, 2, {flags})" if rule.min_tail else "m"
        spans.append(f"""
  SELECT doc_id, {order} AS o, '{rule.kind}' AS kind,
         list_transform(range(1, len(m) + 1), lambda i: {{
           's': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
           'n': length(m[i]), 't': length(list_transform(m, lambda m: {tail})[i])}}) AS found,
         {rule.min_length} AS least, {rule.min_tail} AS least_tail
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {quoted}, 0, {flags}) AS m,
               regexp_split_to_array(coalesce(text, ''), {quoted}, {flags}) AS g FROM documents)""")
    return f"""
WITH runs AS ({" UNION ALL ".join(spans)}),
spans AS (
  SELECT doc_id, o, kind, f.s::BIGINT AS s, (f.s + f.n)::BIGINT AS e
  FROM (SELECT doc_id, o, kind, unnest(found) AS f, least, least_tail FROM runs)
  WHERE f.n >= least AND f.t >= least_tail),
joined AS (
  SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
         count(*) FILTER (o = 2) AS n_hex,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, o) FILTER (o < 3) AS base,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, o) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)"""


_SUFFIX_DEDUP = """
WITH t AS (SELECT doc_id, hex(coalesce(text, '')) AS hx FROM documents),
pieces AS (
  SELECT doc_id, c, substr(hx, 2 * c + 1, 2198) AS hx
  FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - 99, 1000)) AS c FROM t)),
starts AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth
  FROM (SELECT doc_id, c + i AS p, md5_number(substr(hx, 2 * i + 1, 200)) AS k
        FROM (SELECT doc_id, c, hx, unnest(range(0, least(1000, length(hx) // 2 - 99))) AS i FROM pieces))),
repeats AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh
        FROM starts WHERE nth > 1)),
runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM repeats GROUP BY doc_id, run),
removed AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id),
gaps AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b
  FROM (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, -1, 0 FROM t)),
kept AS (
  SELECT t.doc_id, string_agg(CASE WHEN g.b IS NULL THEN substr(hx, 2 * g.a + 1)
                                   ELSE substr(hx, 2 * g.a + 1, 2 * (g.b - g.a)) END, '' ORDER BY g.a) AS hx
  FROM t JOIN gaps g ON t.doc_id = g.doc_id GROUP BY t.doc_id)
SELECT t.doc_id, CAST(length(t.hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.hx)) AS kept_sha256
FROM t JOIN kept ON t.doc_id = kept.doc_id LEFT JOIN removed ON t.doc_id = removed.doc_id"""

# The smallest node that links lead to; ``links`` has both directions.
_REACHABLE = """
reach(node, other) AS (
  SELECT node, node FROM nodes
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

_EMBEDDING_DEDUP = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS node, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT * FROM nodes
  WHERE len(e) > 0 AND list_sum(list_transform(e, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0
    AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
links AS (
  SELECT a.node AS a, b.node AS b FROM usable a JOIN usable b ON a.node <> b.node AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
{_REACHABLE}
SELECT node AS vec_id, (SELECT count(*) FROM links WHERE a = node) AS n_links, component_id, node = component_id AS kept
FROM component"""

_NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
nodes AS (SELECT doc_id AS node, CAST(len(s) AS BIGINT) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN nodes x ON a = x.node JOIN nodes y ON b = y.node
  WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
{_REACHABLE}
SELECT node AS doc_id, n AS n_shingles, component_id, node = component_id AS kept FROM component JOIN nodes USING (node)"""

_FILL_IN_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256(concat('7:', doc_id)) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n,
         list_transform(range(0, 4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS h FROM units),
formed AS (
  SELECT doc_id, t, u, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts"""

_WARC_ARCHIVE = """
WITH hashed AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
named AS (
  SELECT page_id, b, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(h, 5 * g + 1, 5) AS BIGINT) >> (15 - 5 * i)) & 31 AS BIGINT) + 1, 1)), '')), '') AS digest
  FROM hashed),
first AS (SELECT *, min(page_id) OVER (PARTITION BY b) AS smallest FROM named)
SELECT page_id, octet_length(b) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = smallest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> smallest THEN smallest END AS refers_to
FROM first"""

_FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
judged AS (
  SELECT doc_id, part, concat(
    CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS mask FROM texts),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
masks AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)),
told AS (
  SELECT part, filter_order, step, f, n, good, toxic, mask, contains(mask, f) AS fails,
         translate(mask, before, '') = mask AS here FROM masks, steps),
counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f, coalesce(sum(n) FILTER (here AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (here AND fails), 0) AS removed, coalesce(sum(n) FILTER (fails AND NOT here), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = f), 0) AS unique_fails, coalesce(sum(good) FILTER (here AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (here AND fails), 0) AS toxic_lost
  FROM told GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""

ORACLES = {
    "op1_suffix_array_dedup": _SUFFIX_DEDUP,
    "op3_embedding_near_dedup": _EMBEDDING_DEDUP,
    "op7_minhash_near_dedup": _NEAR_DEDUP,
    "op6_url_filter": _URL_FILTER,
    "op8_secret_scan": _secret_sql(),
    "op11_fill_in_middle": _FILL_IN_MIDDLE,
    "op12_warc_archive": _WARC_ARCHIVE,
    "op13_filter_audit": _FILTER_AUDIT,
}
