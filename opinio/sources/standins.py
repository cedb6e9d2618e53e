"""Products, reviews and document snapshots derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("primary_category"),
        F.col("p_type").alias("secondary_category"),
        F.col("p_size").cast("string").alias("tertiary_category"),
        F.col("p_name").alias("highlights"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as reviews; the rating is text on purpose."""
    rating = 1 + F.col("l_quantity").cast("int") % 5
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        rating.cast("string").alias("rating"),
        (rating >= 4).cast("int").cast("double").alias("is_recommended"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("review_text"),
        F.col("l_extendedprice").alias("price_usd"),
    )


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as an indexable review table."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("review_text"),
        "lang",
        "source",
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text")
    )


def snapshots(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The corpus before and after a day of changes.

    Source ``src0`` lands late (inserts), toxic documents are taken down
    (deletes), and documents judged good get an editor's note (updates).
    """
    now = corpus(spark, folder)
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", "id")
    before = now.where(F.col("source") != "src0")
    judged = now.join(labels, "id", "left")
    after = judged.where(F.coalesce("toxic", F.lit(0)) == 0).select(
        "id",
        F.when(F.col("quality") == 1, F.concat("review_text", F.lit(" approved")))
        .otherwise(F.col("review_text"))
        .alias("review_text"),
        "lang",
        "source",
    )
    return before, after
