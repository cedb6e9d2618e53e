"""The operators' queries over the given tables, and their SQL where it exists."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm import (
    chat,
    decontaminate,
    importance,
    language,
    packing,
    pii,
    quality,
    simhash,
    threshold,
    token_files,
    urls,
    vector_codes,
    warc,
)
from opinio.llm.common import fold, stored, table

VOCABULARY = "word_bpe_49k.json"

# Fixed rules of op4.
RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)
# Fixed first labels of the hosts (www. and m. left out) whose pages make up op4's list of URLs.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    languages = language.fit(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return language.predict(docs, languages).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "lang_rejected"
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from four of five folds of the labelled ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    net = quality.fit(docs, labels)
    return quality.scores(docs, net).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, then read back from the output."""
    extra = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user'), (-7L, 1L, 'assistant') AS t(conv_id, turn, role)"
    ).withColumn("text", F.lit(r"\### Assistant: </turn> ok"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = rows.unionByName(extra).withColumn("parts", F.array(chat.text_part(F.col("text"))))
    read = chat.format_conversations(messages).withColumn("_read", chat.read_back())
    learned = F.array_join(
        F.transform(F.filter("_read", lambda t: t["learned"]), lambda t: t["text"]), ""
    )
    every = F.array_join(
        F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("_read").cast("bigint").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), seen AS (
  SELECT *, length(role) + length(text) + 6 + 8
    + length(regexp_replace(role, '[^\\<#:]', '', 'g'))
    + length(regexp_replace(text, '[^\\<#:]', '', 'g')) AS n FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM seen GROUP BY conv_id
"""


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page URL by the rules; the list holds the URLs of the listed hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    label = F.substring_index(F.substring_index(urls.canonical(F.col("url")), "/", 1), ".", 1)
    listed = pages.where(label.isin(*LISTED_LABELS))
    judged = urls.judge_urls(pages, RULES, listed.select("url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = rf"""
WITH cut AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), named AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') AS canon,
    '.' || host AS dotted FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN ends_with(dotted, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with(dotted, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with(dotted, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM named
), listed AS (
  SELECT DISTINCT canon FROM named
  WHERE split_part(split_part(canon, '/', 1), '.', 1) IN {LISTED_LABELS}
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN canon <> '' AND canon IN (SELECT canon FROM listed) THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids, one row per piece."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, public_tokenizers.path(VOCABULARY))
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over 3-word shingles; components of those within 2 bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, words=3, radius=2)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as token files and read back: place and checksum of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = token_files.token_file_round_trip(docs, public_tokenizers.path(VOCABULARY))
    digests = read.select(
        "doc_id",
        "place",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    # a few numbers per document, needed twice: the files are decoded once
    digests = stored(digests, "digests")
    return token_files.with_starts(digests).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, a digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, out="pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.spelled(base), 256).alias("base_sha256"),
        pii.spelled(F.col("pii")).alias("spans"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a benchmark passage, the item, and where in the text it stands."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return threshold.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10
"""


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back: digest, type and what a revisit refers to."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_round_trip(pages).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# base32: every five hex digits of the SHA-1 are four letters
OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages
), placed AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h,
    row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS n,
    first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS response
  FROM p
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER)
      >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n > 1 THEN response END AS refers_to
FROM placed
"""


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, its score, and the tenth that is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark"))


# crc32 of each distinct word byte by byte, eight bits a byte
OP12_SQL = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), target_words AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), found AS (SELECT r, unnest(words) AS word FROM doc_words
), wanted AS (SELECT unnest(words) AS word FROM target_words
), bytes AS (
  SELECT word, hex(word) AS h FROM (SELECT word FROM found UNION SELECT word FROM wanted)
), coded AS (
  SELECT word, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(length(h) / 2 AS BIGINT)),
      lambda i: CAST(CAST('0x' || substr(h, CAST(2 * i + 1 AS INTEGER), 2) AS INTEGER) AS BIGINT))),
    lambda acc, b: list_reduce(
      list_prepend(xor(acc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda c, zero: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)),
    CAST(4294967295 AS BIGINT)) % 10000 AS bucket
  FROM bytes
), s AS (SELECT bucket, count(*) AS s FROM found JOIN coded USING (word) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS t FROM wanted JOIN coded USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM found) AS s_all, (SELECT count(*) FROM wanted) AS t_all
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (CAST(coalesce(t, 0) AS DOUBLE) + 1) * (s_all + 10000)
      / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket) CROSS JOIN totals
), weights AS (
  SELECT r, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM found JOIN coded USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:'
      || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM doc_words LEFT JOIN weights USING (r)
), drawn AS (
  SELECT *, n_features >= 20 AS able,
    row_number() OVER (PARTITION BY n_features >= 20
      ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank FROM drawn
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as eight entry numbers, with its error, its label's error and the codebooks' digest."""
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op13_sql(rounds: int = 6) -> str:
    """The rounds one after the other: nearest entries, then floored means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""code{i} AS (
  SELECT r, part, entry, distance FROM (
    SELECT p.r, p.part, b.entry, d.distance,
      row_number() OVER (PARTITION BY p.r, p.part ORDER BY d.distance, b.entry) AS n
    FROM parts p JOIN book{i} b ON b.part = p.part, LATERAL (SELECT list_sum(list_transform(range(1, len(p.x) + 1),
      lambda k: (p.x[k] - b.x[k]) * (p.x[k] - b.x[k])))::BIGINT AS distance) d
  ) WHERE n = 1)""")
        if i < rounds:
            steps.append(f"""mean{i} AS (
  SELECT part, entry, list(m ORDER BY k) AS x FROM (
    SELECT c.part, c.entry, k, CAST(floor(sum(p.x[k])::DOUBLE / count(*)) AS BIGINT) AS m
    FROM code{i} c JOIN parts p USING (r, part), range(1, 9) t(k) WHERE k <= len(p.x)
    GROUP BY c.part, c.entry, k) GROUP BY part, entry
), book{i + 1} AS (
  SELECT part, entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m USING (part, entry))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT r, part, v[1 + part * (len(v) // 8):(part + 1) * (len(v) // 8)] AS x FROM kept, range(8) t(part)
), book0 AS (SELECT part, r - 1 AS entry, x FROM parts WHERE r <= 16
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
    CAST(sum(distance) AS BIGINT) AS error FROM code{rounds} GROUP BY r
), digest AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, k)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS k FROM book{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256 FROM kept JOIN coded USING (r), digest
"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_chat_format": op3_chat_format,
    "op4_url_filter": op4_url_filter,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_token_files": op7_token_files,
    "op8_pii": op8_pii,
    "op9_decontaminate": op9_decontaminate,
    "op10_top_k": op10_top_k,
    "op11_warc": op11_warc,
    "op12_importance": op12_importance,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = {
    "op3_chat_format": OP3_SQL,
    "op4_url_filter": OP4_SQL,
    "op10_top_k": OP10_SQL,
    "op11_warc": OP11_SQL,
    "op12_importance": OP12_SQL,
    "op13_vector_codes": op13_sql(),
}
