"""Rating statistics per product and the choice of the most divisive one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Selection:
    """Fixed values of the gold rule; the centre is 2.5 although ratings span 1 to 5."""

    lowest: float = 1.0
    highest: float = 5.0
    centre: float = 2.5
    min_reviews: int = 30
    max_reviews: int = 50


def as_score(rating: Column) -> Column:
    """The rating as a double, NULL when it is not a number."""
    return rating.try_cast("double")


def rating_stats(reviews: DataFrame) -> DataFrame:
    """Count, mean, minimum and maximum of the usable ratings of each product.

    Two columns are read and partial sums are taken before the shuffle, so a
    product with very many reviews sends one row per task.
    """
    scored = reviews.select("product_id", as_score(F.col("rating")).alias("score"))
    # fixed values: the four output names
    return scored.groupBy("product_id").agg(
        F.count("score").alias("cnt"),
        F.avg("score").alias("rating_avg"),
        F.min("score").alias("rating_min"),
        F.max("score").alias("rating_max"),
    )


def spans_scale(rule: Selection = Selection()) -> Column:
    return (F.col("rating_min") == rule.lowest) & (F.col("rating_max") == rule.highest)


def polarised(stats: DataFrame, rule: Selection = Selection()) -> DataFrame:
    """Products rated at both ends of the scale by a bounded number of reviewers."""
    enough = F.col("cnt").between(rule.min_reviews, rule.max_reviews)
    return stats.where(spans_scale(rule) & enough)


def divisiveness(stats: DataFrame, rule: Selection = Selection()) -> DataFrame:
    """Distance of the mean from the centre for products that span the scale."""
    return stats.where(spans_scale(rule)).withColumn("diff", _distance(rule))


def ranked(divisive: DataFrame) -> DataFrame:
    """Closest to the centre first, lower product id on ties."""
    return divisive.orderBy(F.asc_nulls_first("diff"), F.asc("product_id"))


def most_divisive(reviews: DataFrame, rule: Selection = Selection()) -> DataFrame:
    """At most one row: the id of the chosen product."""
    candidates = polarised(rating_stats(reviews), rule).withColumn("diff", _distance(rule))
    return ranked(candidates).select("product_id").limit(1)


def gold(silver: DataFrame, rule: Selection = Selection()) -> DataFrame:
    """All silver rows of the chosen product, none if no product qualifies.

    The id is a scalar subquery: it never visits the driver program, and it
    reaches the parquet scan as a pushed filter once it is known.
    """
    chosen = most_divisive(silver, rule).scalar()
    return silver.where(F.col("product_id") == chosen)


def gold_by_join(silver: DataFrame, rule: Selection = Selection()) -> DataFrame:
    """The same rows by joining with the one-row selection (bounded by its limit)."""
    return silver.join(F.broadcast(most_divisive(silver, rule)), "product_id")


def _distance(rule: Selection) -> Column:
    return F.abs(F.lit(rule.centre) - F.col("rating_avg"))
