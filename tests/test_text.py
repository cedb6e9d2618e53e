import hashlib
import math
from collections import Counter

import regex
from pyspark.sql import functions as F

from opinio.functions.text import distinct_terms, hashed_sparse, hashed_vector, term_counts, tokens
from opinio.sources import standins


def words(text):
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if t]


def bucket(term):
    return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % 256


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column(F.col("text"))).first()[0]


def test_terms_of_odd_texts(spark):
    assert one(spark, "Don't  STOP—été 42!", tokens) == ["don", "t", "stop", "été", "42"]
    for text in ("", None, "... !"):
        assert one(spark, text, tokens) == []
        assert one(spark, text, term_counts) == []
        assert one(spark, text, distinct_terms) == []
        vector = one(spark, text, lambda c: hashed_vector(term_counts(c)))
        assert len(vector) == 256 and not any(vector)
    assert [tuple(r) for r in one(spark, "b a b", term_counts)] == [("a", 1), ("b", 2)]
    assert one(spark, "b a b", distinct_terms) == ["a", "b"]


def test_whole_documents_match_a_plain_count(spark, data):
    counted = standins.corpus(spark, data).select(
        "id", "review_text", term_counts(F.col("review_text")).alias("terms")
    )
    rows = counted.select(
        "*",
        hashed_sparse(F.col("terms")).alias("sparse"),
        hashed_vector(F.col("terms")).alias("dense"),
    ).collect()
    for row in rows:
        expected = Counter(words(row.review_text))
        assert {t.term: t.tf for t in row.terms} == expected
        assert [t.term.encode() for t in row.terms] == sorted(t.encode() for t in expected)
        hashed = Counter()
        for term, n in expected.items():
            hashed[bucket(term)] += n
        assert {e.bucket: e.n for e in row.sparse} == hashed
        norm = math.sqrt(sum(n * n for n in hashed.values()))
        for b in range(256):
            assert math.isclose(row.dense[b], hashed[b] / norm, rel_tol=1e-6, abs_tol=0)
