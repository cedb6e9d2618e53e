import math
from collections import Counter

from pyspark.sql import functions as F
from test_text import bucket, words

from opinio.functions import counting
from opinio.functions.text import hashed_sparse, hashed_vector, term_counts

TEXTS = [
    None, "", " ?! ", "Good GOOD cream, good!", "Äpfel äpfel straße ÉTÉ", "a1 2b 1a ½ ²", "水 水 x", "İstanbul ı",
    "word " * 40_000 + "end", "tab\tnew\nline nbsp", "b a c b a b",
]


def test_batches_equal_the_column_expressions(spark, monkeypatch):
    monkeypatch.setattr(counting, "BYTES_AT_ONCE", 40)
    rows = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS * 3)], "id long, text string, terms_of string")
    got = counting.with_counts(rows, "text").repartition(3)
    want = rows.withColumn("terms", term_counts(F.col("text"))).withColumn("embedding", hashed_vector(F.col("terms")))
    total = F.aggregate("terms", F.lit(0), lambda a, x: a + x["tf"])
    want = want.withColumn("n_terms", total).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    sparse = counting.with_counts(rows, "text", "sparse").select("id", "embedding")
    plain = rows.select("id", hashed_sparse(term_counts(F.col("text"))).alias("embedding"))
    theirs = {r.id: [tuple(e) for e in r.embedding or []] for r in plain.collect()}
    for r in sparse.collect():
        mine = [tuple(e) for e in r.embedding]
        assert [e[:2] for e in mine] == [e[:2] for e in theirs[r.id]]
        assert all(math.isclose(a[2], b[2]) for a, b in zip(mine, theirs[r.id]))


def test_terms_equal_plain_python(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    for r in counting.with_counts(documents, "text", None).collect():
        assert {t.term: t.tf for t in r.terms} == Counter(words(r.text))
        assert r.n_terms == sum(t.tf for t in r.terms)
    some = counting.with_counts(documents.limit(5), "text", "sparse").collect()
    for r in some:
        assert {e.bucket: e.n for e in r.embedding} == Counter(bucket(t) for t in words(r.text))


def test_no_rows(spark):
    none = spark.createDataFrame([], "id long, text string")
    assert counting.with_counts(none, "text").count() == 0
