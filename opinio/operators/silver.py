"""Products joined with their reviews, and row ids for the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.rows import fingerprint
from opinio.session import checked_broadcast, new_path, shuffle_partitions

# The input columns that reach the silver table, in its order.
PRODUCT_COLUMNS = [
    "product_id",
    "product_name",
    "primary_category",
    "secondary_category",
    "tertiary_category",
    "highlights",
]
REVIEW_COLUMNS = ["product_id", "rating", "is_recommended", "review_text", "price_usd"]

COPIES_AT_ONCE = 1_000
RANGES_PER_ROW = 100_000


def join_reviews(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every review with its product; rows without a partner or a key drop out.

    No hint: a small catalogue is broadcast by its measured size, a large one is
    sort-merge joined and adaptive execution splits a product that owns a large
    share of the reviews. Where the two key types differ, a review's key is read as the
    catalogue's type; one that cannot be drops out, like any other without a partner.
    """
    catalogue = products.select(*PRODUCT_COLUMNS)
    rated = reviews.select(*REVIEW_COLUMNS)
    kind = catalogue.schema["product_id"].dataType
    if rated.schema["product_id"].dataType != kind:
        rated = rated.withColumn("product_id", F.col("product_id").try_cast(kind))
    return catalogue.join(rated, "product_id")


def with_surrogate_id(rows: DataFrame, name: str = "id") -> DataFrame:
    """Unique, increasing, neither consecutive nor stable between runs."""
    return rows.withColumn(name, F.monotonically_increasing_id())


def with_stable_id(
    rows: DataFrame,
    name: str = "id",
    copies_at_once: int = COPIES_AT_ONCE,
    ranges_per_row: int = RANGES_PER_ROW,
) -> DataFrame:
    """Fingerprint of the row plus its number among equal rows.

    Fingerprints alone are shuffled and counted (map-side first). A row whose fingerprint is
    not among the repeated ones, which are written and travel to the rows where their counted
    size allows it, gets number 1 where it is. Only repeated rows move: equal rows are
    interchangeable, so they are counted and written out again with numbers 1..n instead of
    being ranked in one window group. A count above ``copies_at_once`` is first cut into
    ranges, and the ranges are shuffled apart, so a row repeated in a third of the input is
    numbered by many tasks. The partition count of that shuffle is fixed: adaptive
    execution would merge the few bytes the ranges take before they unfold.
    """
    spark, columns = rows.sparkSession, rows.columns
    # own names inside, so that a column may be named as anything made here
    plain = rows.toDF(*(f"c{i}" for i in range(len(columns))))
    kept = plain.columns
    marked = plain.withColumn("mark", fingerprint(rows, columns, kept))
    path = new_path(spark, "repeated")
    mark = F.unhex("mark").alias("mark")
    marked.select(mark).groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > 1
    ).write.parquet(path)
    repeated = spark.read.parquet(path).select(F.lower(F.hex("mark")).alias("mark"))
    known = checked_broadcast(repeated, repeated.count())
    single = marked.join(known, "mark", "left_anti").withColumn("number", F.lit(1).cast("bigint"))

    copies = marked.join(known, "mark", "left_semi")
    counted = copies.groupBy("mark", *kept).agg(F.count(F.lit(1)).alias("copies"))
    one = F.lit(1).cast("bigint")
    few = counted.where(F.col("copies") <= copies_at_once).select(
        "mark", *kept, F.explode(F.sequence(one, "copies")).alias("number")
    )
    share = F.ceil(F.col("copies") / ranges_per_row).cast("bigint")
    ranges = (
        counted.where(F.col("copies") > copies_at_once)
        .withColumn("step", F.greatest(F.lit(copies_at_once).cast("bigint"), share))
        .withColumn("first", F.explode(F.sequence(one, F.col("copies"), F.col("step"))))
        .repartition(shuffle_partitions(spark), *kept, "first")
    )
    last = F.least(F.col("first") + F.col("step") - 1, F.col("copies"))
    many = ranges.select("mark", *kept, F.explode(F.sequence("first", last)).alias("number"))

    every = single.unionByName(few).unionByName(many)
    return every.select(
        *(F.col(c).alias(original) for c, original in zip(kept, columns)),
        F.concat("mark", F.lit("-"), F.col("number").cast("string")).alias(name),
    )


def id_check(rows: DataFrame, name: str = "id") -> DataFrame:
    """One row: number of rows and number of different ids."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col(name)).alias("n_ids")
    )
