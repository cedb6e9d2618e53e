"""The registered queries once more, as DuckDB SQL over the same tables."""

from __future__ import annotations

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS primary_category,
         p_type AS secondary_category, CAST(p_size AS VARCHAR) AS tertiary_category,
         p_name AS highlights
  FROM part)"""

SILVER = (
    PRODUCTS
    + """,
reviews AS (
  SELECT l_partkey AS product_id, CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) AS rating,
         CASE WHEN 1 + CAST(l_quantity AS INTEGER) % 5 >= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           AS is_recommended,
         concat_ws(' ', l_returnflag, l_linestatus) AS review_text,
         l_extendedprice AS price_usd
  FROM lineitem),
silver AS (
  SELECT product_id, product_name, primary_category, secondary_category, tertiary_category,
         highlights, rating, is_recommended, review_text, price_usd
  FROM products JOIN reviews USING (product_id))"""
)

STATS = (
    SILVER
    + """,
stats AS (
  SELECT product_id, count(TRY_CAST(rating AS DOUBLE)) AS cnt,
         avg(TRY_CAST(rating AS DOUBLE)) AS rating_avg,
         min(TRY_CAST(rating AS DOUBLE)) AS rating_min,
         max(TRY_CAST(rating AS DOUBLE)) AS rating_max
  FROM silver GROUP BY product_id)"""
)

GOLD = (
    STATS
    + """,
chosen AS (
  SELECT product_id FROM stats
  WHERE rating_min = 1.0 AND rating_max = 5.0 AND cnt BETWEEN 30 AND 50
  ORDER BY abs(2.5 - rating_avg) NULLS FIRST, product_id LIMIT 1),
gold AS (SELECT silver.* FROM silver JOIN chosen USING (product_id))"""
)


def _encoded(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')"


_SILVER_COLUMNS = [
    "product_id", "product_name", "primary_category", "secondary_category",
    "tertiary_category", "highlights", "rating", "is_recommended", "review_text", "price_usd",
]
_ROW = " || ".join(_encoded(column) for column in _SILVER_COLUMNS)

IDENTIFIED = (
    SILVER
    + f""",
marked AS (SELECT *, md5({_ROW}) AS mark FROM silver),
identified AS (
  SELECT * EXCLUDE (mark),
         mark || '-' || CAST(row_number() OVER (PARTITION BY mark) AS VARCHAR) AS id
  FROM marked)"""
)

SNAPSHOTS = """
before AS (
  SELECT doc_id AS id, text AS review_text, lang, source FROM documents WHERE source <> 'src0'),
after AS (
  SELECT d.doc_id AS id,
         CASE WHEN l.quality = 1 THEN d.text || ' approved' ELSE d.text END AS review_text,
         d.lang, d.source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  WHERE coalesce(l.toxic, 0) = 0)"""


def _postings(source: str, key: str, text: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT {key} AS id, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS term
    FROM {source}) WHERE term <> '' GROUP BY id, term)"""


DOCUMENT_POSTINGS = _postings("documents", "doc_id", "text", "postings")
QUESTION_POSTINGS = _postings("benchmark", "item_id", "text", "asked")


def _vectors(postings: str, name: str) -> str:
    return f"""
{name}_counts AS (
  SELECT id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 256 AS bucket,
         CAST(sum(tf) AS BIGINT) AS n
  FROM {postings} GROUP BY ALL),
{name} AS (
  SELECT id, bucket, n, n / sqrt(CAST(sum(n * n) OVER (PARTITION BY id) AS DOUBLE)) AS weight
  FROM {name}_counts)"""


def _cosine(vectors: str, asked: str, name: str, depth: int) -> str:
    """Both sides rounded to single precision first, as the index stores them."""
    return f"""
{name}_d AS (SELECT id, bucket, CAST(CAST(weight AS FLOAT) AS DOUBLE) AS w FROM {vectors}),
{name}_q AS (SELECT id, bucket, CAST(CAST(weight AS FLOAT) AS DOUBLE) AS w FROM {asked}),
{name}_dn AS (SELECT id, sqrt(sum(w * w)) AS norm FROM {name}_d GROUP BY id),
{name}_qn AS (SELECT id, sqrt(sum(w * w)) AS norm FROM {name}_q GROUP BY id),
{name}_dots AS (
  SELECT q.id AS query_id, d.id AS id, sum(q.w * d.w) AS dot
  FROM {name}_q q JOIN {name}_d d USING (bucket) GROUP BY ALL),
{name}_scores AS (
  SELECT query_id, s.id AS id, round(dot / (qn.norm * dn.norm), 6) AS score
  FROM {name}_dots s JOIN {name}_dn dn ON s.id = dn.id JOIN {name}_qn qn ON s.query_id = qn.id),
{name} AS (
  SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM {name}_scores WHERE score > 0) WHERE rank <= {depth})"""


def _bm25(asked: str, name: str, depth: int) -> str:
    return f"""
{name}_len AS (SELECT id, sum(tf) AS len FROM postings GROUP BY id),
{name}_all AS (
  SELECT (SELECT count(*) FROM documents) AS n_docs,
         (SELECT CAST(sum(tf) AS DOUBLE) FROM postings) / (SELECT count(*) FROM documents) AS mean),
{name}_df AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
{name}_scores AS (
  SELECT q.id AS query_id, p.id AS id,
         round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5))
           * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 4) AS score
  FROM (SELECT DISTINCT id, term FROM {asked}) q
  JOIN (SELECT id, term, CAST(tf AS DOUBLE) AS tf FROM postings) p USING (term)
  JOIN {name}_df USING (term) JOIN {name}_len l ON l.id = p.id CROSS JOIN {name}_all
  GROUP BY ALL),
{name} AS (
  SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM {name}_scores) WHERE rank <= {depth})"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _hybrid(depth: int, k: int, *asked: str) -> str:
    """Both rankings ``depth`` deep, fused: the first ``k`` of each query as ``best``."""
    return _with(
        DOCUMENT_POSTINGS,
        *(asked or [QUESTION_POSTINGS]),
        _vectors("postings", "vectors"),
        _vectors("asked", "questions"),
        _cosine("vectors", "questions", "near", depth),
        _bm25("asked", "worded", depth),
        f"""
fused AS (
  SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM (
    SELECT query_id, id, rank FROM near UNION ALL SELECT query_id, id, rank FROM worded)
  GROUP BY query_id, id),
best AS (
  SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fused)
  WHERE rank <= {k})""",
    )


LAST_TEXT = """
last_text AS (
  SELECT conv_id, CASE WHEN count(*) FILTER (WHERE role = 'user') > 0
    THEN coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '')
    ELSE coalesce(arg_max(text, turn), '') END AS last_text
  FROM conversations GROUP BY conv_id)"""

SYNCED = f"""{SNAPSHOTS},{_postings("after", "id", "review_text", "postings")}
"""
_SUMMARY = """
SELECT a.id, review_text, lang, source, coalesce(n_postings, 0) AS n_postings,
       coalesce(n_tokens, 0) AS n_tokens
FROM after a LEFT JOIN (
  SELECT id, count(*) AS n_postings, CAST(sum(tf) AS BIGINT) AS n_tokens
  FROM postings GROUP BY id) USING (id)"""

ORACLES: dict[str, str] = {
    "csv_scan": """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM part""",
    "csv_glob_scan": """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_orderpriority
FROM orders""",
    "file_lineage": "SELECT *, 'part' AS file_name, true AS has_time FROM part",
    "preview": _with(SILVER)
    + "SELECT least(count(*), 10) AS n_rows, least(count(*), 10) AS n_silver FROM silver",
    "semantic_topk_approx": """
SELECT vec_id AS query_id, least(3, (SELECT count(*) - 1 FROM embeddings)) AS n_exact,
       true AS recall_holds, true AS few_scored
FROM embeddings WHERE vec_id % 50 = 0""",
    "csv_split_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_by_header": """
SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS p_size,
       CASE WHEN p_partkey % 100 <> 7 THEN p_retailprice END AS p_retailprice,
       p_partkey % 100 = 7 AS is_bad
FROM part""",
    "csv_multiline_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "loaded_files": """
SELECT l_returnflag AS flag, count(*) AS n_rows FROM lineitem GROUP BY l_returnflag""",
    "table_overwrite": _with(PRODUCTS) + "SELECT * FROM products",
    "layered_gold": _with(GOLD, IDENTIFIED.removeprefix(SILVER).removeprefix(",\n"))
    + "SELECT identified.* FROM identified JOIN chosen USING (product_id)",
    "silver_join": _with(SILVER) + "SELECT * FROM silver",
    "product_rating_stats": _with(STATS) + "SELECT * FROM stats",
    "polarised_products": _with(STATS)
    + """
SELECT * FROM stats WHERE rating_min = 1.0 AND rating_max = 5.0 AND cnt BETWEEN 30 AND 50""",
    "product_divisiveness": _with(STATS)
    + """
SELECT *, abs(2.5::DOUBLE - rating_avg) AS diff FROM stats
WHERE rating_min = 1.0 AND rating_max = 5.0 ORDER BY diff NULLS FIRST, product_id""",
    "gold_product": _with(GOLD) + "SELECT * FROM gold",
    "gold_product_join": _with(GOLD) + "SELECT * FROM gold",
    "lenient_rating_cast": """
SELECT event_id, substr(props, 7, 2) AS raw, TRY_CAST(substr(props, 7, 2) AS DOUBLE) AS score
FROM events""",
    "stable_row_id": _with(IDENTIFIED) + "SELECT * FROM identified",
    "surrogate_id_unique": _with(SILVER)
    + "SELECT count(*) AS n_rows, count(*) AS n_ids FROM silver",
    "distinct_sources": "SELECT DISTINCT source FROM documents",
    "hashed_embedding": _with(DOCUMENT_POSTINGS, _vectors("postings", "vectors"))
    + "SELECT id, bucket, CAST(n AS INTEGER) AS n, round(weight, 6) AS weight FROM vectors",
    "query_embedding": _with(QUESTION_POSTINGS, _vectors("asked", "vectors"))
    + """
SELECT id AS query_id, CAST(bucket AS INTEGER) AS bucket,
       round(CAST(CAST(weight AS FLOAT) AS DOUBLE), 6) AS weight
FROM vectors""",
    "index_build": _with(DOCUMENT_POSTINGS)
    + """
SELECT 'rows' AS what, count(*) AS n, count(DISTINCT doc_id) AS n_keys FROM documents
UNION ALL
SELECT 'postings' AS what, count(*) AS n, CAST(sum(tf) AS BIGINT) AS n_keys FROM postings""",
    "index_terms": _with(DOCUMENT_POSTINGS)
    + "SELECT term, count(*) AS df FROM postings GROUP BY term",
    "index_stats": _with(DOCUMENT_POSTINGS)
    + """
SELECT (SELECT count(*) FROM documents) AS n_docs, count(DISTINCT term) AS n_distinct_terms,
       256 AS dimension,
       round(CAST(sum(tf) AS DOUBLE) / (SELECT count(*) FROM documents), 6) AS mean_terms,
       true AS estimate_holds
FROM postings""",
    "index_change_set": _with(SNAPSHOTS)
    + """
SELECT coalesce(b.id, a.id) AS id,
       CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END
         AS change
FROM before b FULL OUTER JOIN after a ON a.id = b.id
WHERE b.id IS NULL OR a.id IS NULL OR a.review_text IS DISTINCT FROM b.review_text
   OR a.lang IS DISTINCT FROM b.lang OR a.source IS DISTINCT FROM b.source""",
    "snapshot_after_changes": _with(SNAPSHOTS) + "SELECT * FROM after",
    "index_after_sync": _with(SYNCED) + _SUMMARY,
    "index_terms_after_sync": _with(SYNCED)
    + "SELECT term, count(*) AS df FROM postings GROUP BY term",
    "stream_sync": _with(SYNCED) + _SUMMARY,
    "semantic_topk": """
WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
s AS (
  SELECT q.id AS query_id, d.id AS id,
         round(list_dot_product(q.e, d.e) / (q.norm * d.norm), 6) AS score
  FROM u q CROSS JOIN u d)
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
WHERE rank <= 3""",
    "semantic_text_topk": _with(
        DOCUMENT_POSTINGS,
        QUESTION_POSTINGS,
        _vectors("postings", "vectors"),
        _vectors("asked", "questions"),
        _cosine("vectors", "questions", "hits", 3),
    )
    + """
SELECT query_id, rank, id, score, lang, source, text AS review_text
FROM hits JOIN documents ON doc_id = id""",
    "fulltext_topk": _with(DOCUMENT_POSTINGS, QUESTION_POSTINGS, _bm25("asked", "hits", 3))
    + "SELECT query_id, id, score, rank FROM hits",
    "hybrid_topk": _hybrid(50, 3) + "SELECT query_id, id, score, rank FROM best",
    "hybrid_topk_deep": _hybrid(60, 60) + "SELECT query_id, id, score, rank FROM best",
    "question_context": _hybrid(50, 3)
    + """
SELECT query_id, rank - 1 AS position, id, text, score FROM best JOIN documents ON doc_id = id""",
    "last_user_text": _with(LAST_TEXT) + "SELECT * FROM last_text",
    "conversation_context": _with(
        LAST_TEXT,
        DOCUMENT_POSTINGS,
        _postings("last_text", "conv_id", "last_text", "asked"),
        _bm25("asked", "hits", 3),
    )
    + "SELECT query_id, id, score, rank FROM hits",
    "conversation_context_default": _hybrid(
        50, 3, LAST_TEXT, _postings("last_text", "conv_id", "last_text", "asked")
    )
    + """
SELECT query_id, rank - 1 AS position, id, text, score FROM best JOIN documents ON doc_id = id""",
    "extreme_reviews": _with(IDENTIFIED)
    + """,
sided AS (
  SELECT product_id, id, review_text, CAST(rating AS DOUBLE) AS rating, side,
         row_number() OVER (PARTITION BY product_id, side ORDER BY
           CASE side WHEN 'positive' THEN -CAST(rating AS DOUBLE) ELSE CAST(rating AS DOUBLE) END,
           id) AS rank
  FROM identified CROSS JOIN (VALUES ('positive'), ('negative')) s(side))
SELECT product_id, side, CAST(rank AS INTEGER) AS rank, id, rating, review_text
FROM sided WHERE rank <= 3""",
    "text_judged_reviews": _with(
        DOCUMENT_POSTINGS,
        """
marked AS (
  SELECT p.term, p.tf, l.quality FROM postings p JOIN labels l ON l.doc_id = p.id),
sides AS (
  SELECT term, coalesce(sum(tf) FILTER (quality = 1), 0) AS high,
         coalesce(sum(tf) FILTER (quality = 0), 0) AS low
  FROM (SELECT * FROM marked UNION ALL SELECT term, 0 AS tf, NULL AS quality FROM postings)
  GROUP BY term),
totals AS (SELECT sum(high) AS h, sum(low) AS l, count(*) AS v FROM sides),
leanings AS (
  SELECT term, ln((high + 1.0::DOUBLE) / (h + v)) - ln((low + 1.0::DOUBLE) / (l + v)) AS leaning
  FROM sides CROSS JOIN totals),
judged AS (
  SELECT id, round(sum(tf * leaning), 6) AS leaning FROM postings JOIN leanings USING (term)
  GROUP BY id),
sided AS (
  SELECT lang AS product_id, d.doc_id AS id, j.leaning, d.text AS review_text, side,
         row_number() OVER (PARTITION BY lang, side ORDER BY
           CASE side WHEN 'positive' THEN -j.leaning ELSE j.leaning END, d.doc_id) AS rank
  FROM documents d JOIN judged j ON j.id = d.doc_id
  CROSS JOIN (VALUES ('positive'), ('negative')) s(side))""",
    )
    + """
SELECT product_id, side, CAST(rank AS INTEGER) AS rank, id, leaning, review_text
FROM sided WHERE rank <= 3""",
}
