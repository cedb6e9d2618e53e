from pyspark.sql import functions as F

from opinio.operators import reviews
from opinio.sources import tables


def test_extreme_reviews_are_dealt_before_they_are_sorted(spark):
    rows = spark.range(10).select(
        (F.col("id") % 2).alias("product_id"), F.col("id").cast("string").alias("id"),
        F.lit("3").alias("rating"), F.lit("x").alias("review_text"),
    )
    plan = reviews.extreme_reviews(rows)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_a_clustered_table_holds_a_key_in_one_file(spark, tmp_path):
    rows = spark.range(400).repartition(4).select((F.col("id") % 5).alias("product_id"), "id")
    tables.overwrite_table(rows, "dealt", "parquet", str(tmp_path / "t"), cluster_by=["product_id"])
    try:
        found = spark.read.table("dealt").select("product_id", "_metadata.file_path").distinct()
        assert found.count() == 5
    finally:
        spark.sql("DROP TABLE dealt")
