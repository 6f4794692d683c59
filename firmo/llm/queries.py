"""Queries of this folder: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from firmo.llm import (alignment, bpe, decontaminate, html_text, knn, licenses, near_duplicates, pii, quality,
                       spelling, token_store, toxicity, warc)
from firmo.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query("op1_ngram_jaccard_join", f"""
WITH RECURSIVE
  d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
  g AS (SELECT DISTINCT r, array_to_string(w[k:k + 4], ' ') AS s
        FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
  n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
  p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
  l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
  reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
  c AS (SELECT a, min(doc_id) AS class_id FROM reach JOIN d ON d.r = b GROUP BY a),
  k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, class_id, coalesce(n_links, 0) AS n_links,
       CASE WHEN len(w) > 0 THEN min(d.doc_id) OVER (PARTITION BY w) ELSE d.doc_id END AS copy_id,
       CASE WHEN len(w) > 0 THEN count(*) OVER (PARTITION BY w) ELSE 1 END AS n_copies
FROM d JOIN c ON c.a = d.r LEFT JOIN k ON k.a = d.r""")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.query(_read(spark, sf_dir, "documents"))


@_query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@_query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@_query("op4_voronoi_knn", """
WITH e AS (SELECT vec_id, min([floor(64 * x::DOUBLE) for x in embedding]) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id),
     s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
           FROM e q JOIN e d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20""")
def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.query(_read(spark, sf_dir, "embeddings"))


@_query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(_read(spark, sf_dir, "documents"))


@_query("op8_token_store")
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.query(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


#: base32 of the SHA-1: 8 groups of 5 hex digits, each 4 symbols
_BASE32 = """(SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31), 1), '' ORDER BY i) FROM range(32) t(i))"""


@_query("op9_warc", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.query(_read(spark, sf_dir, "pages"))


@_query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.query(_read(spark, sf_dir, "documents"))


@_query("op10_decontaminate", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT DISTINCT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
     win AS (SELECT DISTINCT item, w[k:k + least(len(w), 13) - 1] AS g, least(len(w), 13) AS n
             FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
     n AS (SELECT DISTINCT n FROM win),
     p AS (SELECT r, n, k, w[k:k + n - 1] AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, n WHERE len(w) >= n)),
     m AS (SELECT r, k, p.n, item FROM p JOIN win ON p.n = win.n AND p.g = win.g),
     hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS x FROM m) GROUP BY r),
     its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)""")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


# the rules have no SQL; where a page has one article element with headings and paragraphs, as
# the given ones, what they must return has
@_query("op11_html_text", r"""
WITH a AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(h1|p)>') AS parts FROM pages),
     t AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                  replace(replace(replace(replace(x, '<br>', ' '), '<b>', ''), '</b>', ''), '&#x27;', chr(39)),
                  '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM a),
     j AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM t)
SELECT page_id, url, text, length(text) AS n_chars FROM j""")
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.query(_read(spark, sf_dir, "pages"))


@_query("op13_spelling_variants", r"""
WITH RECURSIVE
  bits AS (SELECT i AS byte, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
           UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
  tbl AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8),
  runs AS (SELECT doc_id, run, count(*) AS c FROM (
             SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY doc_id, run),
  raw AS (SELECT run, c, t, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                 lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 | (ord(x) >> 6), 128 | (ord(x) & 63)] END)) AS b
          FROM runs, tbl WHERE length(run) >= 6),
  hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(b, lambda x: x::BIGINT)),
                    lambda h, x: xor(h >> 8, t[1 + (xor(h, x) & 255)])), 4294967295) AS h FROM raw),
  words AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed),
  v AS (SELECT word, sum(c)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
  d AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
  near AS (SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
           UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
           UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
  best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, near)) AS near FROM near GROUP BY word),
  forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN near END AS form, CASE WHEN m >= 5 * v.n THEN m END AS form_n
            FROM v LEFT JOIN best USING (word)),
  walk AS (SELECT word, word AS root, form AS next FROM forms
           UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON forms.word = walk.next)
SELECT f.word, f.form, root, n, n_near, form_n FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.query(_read(spark, sf_dir, "documents"))


@_query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
