from pyspark.sql import functions as F

from opinio.operators import index as module
from opinio.operators.index import TextIndex
from opinio.session import new_path


def test_long_texts_make_more_buckets(spark, monkeypatch):
    monkeypatch.setattr(module, "BYTES_PER_BUCKET", 1000)
    rows = spark.range(100).select("id", F.repeat(F.lit("cream "), 50).alias("review_text"))
    found = TextIndex(spark, new_path(spark, "index")).build(rows).current()
    assert found.totals.n_buckets == 30
    assert found.postings().agg(F.sum("tf")).first()[0] == 5000


def test_a_bucket_is_a_bounded_number_of_texts(spark):
    assert TextIndex(spark, "unused")._buckets_for(3_000_000, 0) >= 3_000_000 // 10_000
