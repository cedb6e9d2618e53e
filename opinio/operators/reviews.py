"""Per-conversation and per-product picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.counting import with_counts
from opinio.operators.ratings import as_score
from opinio.session import checked_broadcast, new_path

# Ratings from which on a review counts as high, and up to which as low.
HIGH, LOW = 4.0, 2.0
DIGITS = 6


def last_user_text(messages: DataFrame) -> DataFrame:
    """The text to answer in each conversation.

    The last user message, or the last message where no user spoke. A missing
    text gives ''. ``max`` over (turn, text) is combined map-side and does not
    depend on the order in which rows arrive.
    """
    turn = F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))
    by_user = F.when(F.col("role") == "user", turn)
    return (
        messages.groupBy("conv_id")
        .agg(F.max(by_user).alias("_user"), F.max(turn).alias("_any"))
        .select("conv_id", F.coalesce("_user", "_any")["text"].alias("last_text"))
    )


def extreme_reviews(reviews: DataFrame, per_side: int = 3, key: str = "id") -> DataFrame:
    """The ``per_side`` best and worst rated reviews of every product.

    Each review enters both rankings in one pass. Reviews are first dealt by product to tasks of
    even size, whose sorts do not grow with the table. ``row_number() <= n`` is limited
    inside every task before the next shuffle, so a product with very many reviews, which many
    tasks share, sends at most ``per_side`` rows per task and side.
    """
    score = as_score(F.col("rating"))
    sides = F.array(
        F.struct(F.lit("positive").alias("side"), (-F.col("score")).alias("order")),
        F.struct(F.lit("negative").alias("side"), F.col("score").alias("order")),
    )
    entries = (
        reviews.select("product_id", key, "review_text", score.alias("score"))
        .where(F.col("score").isNotNull())
        .hint("rebalance", "product_id")
        .withColumn("_entry", F.explode(sides))
    )
    place = Window.partitionBy("product_id", "_entry.side").orderBy("_entry.order", key)
    return (
        entries.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= per_side)
        .select(
            "product_id",
            F.col("_entry.side").alias("side"),
            "rank",
            key,
            F.col("score").alias("rating"),
            "review_text",
        )
    )


def term_leanings(terms: DataFrame) -> DataFrame:
    """``(term, leaning)`` from ``(term, tf, score)``: log-odds of high against low ratings.

    Add-one smoothed: how much likelier a token of a high review is the term than one of a low
    review. Tokens are combined by term before the shuffle.
    """
    score = F.col("score")
    by_term = terms.groupBy("term").agg(
        F.coalesce(F.sum(F.when(score >= HIGH, F.col("tf"))), F.lit(0)).alias("high"),
        F.coalesce(F.sum(F.when(score <= LOW, F.col("tf"))), F.lit(0)).alias("low"),
    )
    path = new_path(terms.sparkSession, "terms")
    by_term.write.parquet(path)
    counted = terms.sparkSession.read.parquet(path)
    totals = counted.agg(
        F.coalesce(F.sum("high"), F.lit(0)).alias("high"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("low"),
        F.count(F.lit(1)).alias("terms"),
    ).first()

    def odds(side: str) -> Column:
        return (F.col(side) + F.lit(1.0)) / F.lit(float(totals[side] + totals["terms"]))

    return counted.select("term", (F.log(odds("high")) - F.log(odds("low"))).alias("leaning"))


def text_judged_reviews(reviews: DataFrame, per_side: int = 3, key: str = "id") -> DataFrame:
    """The ``per_side`` reviews of every product whose words lean most to high and to low ratings.

    A review's leaning is the sum over its tokens. Which words lean where is learned from all
    reviews with a rating; reviews without one are judged as well. Reviews without a token
    take no part. Ties go to the smaller key.
    """
    spark = reviews.sparkSession
    rated = reviews.select(
        "product_id", key, "review_text", as_score(F.col("rating")).alias("score")
    )
    path = new_path(spark, "postings")
    entry = F.explode("terms").alias("entry")
    with_counts(rated, "review_text", None).select(key, "score", entry).select(
        F.col(key).alias("review"), "score", "entry.term", "entry.tf"
    ).write.parquet(path)
    terms = spark.read.parquet(path)
    stored = new_path(spark, "leanings")
    term_leanings(terms).write.parquet(stored)
    leanings = spark.read.parquet(stored)
    judged = (
        terms.join(checked_broadcast(leanings, leanings.count()), "term")
        .groupBy(F.col("review").alias(key))
        .agg(F.round(F.sum(F.col("tf") * F.col("leaning")), DIGITS).alias("leaning"))
    )
    sides = F.array(
        F.struct(F.lit("positive").alias("side"), (-F.col("leaning")).alias("order")),
        F.struct(F.lit("negative").alias("side"), F.col("leaning").alias("order")),
    )
    place = Window.partitionBy("product_id", "_entry.side").orderBy("_entry.order", key)
    return (
        rated.select("product_id", key, "review_text")
        .join(judged, key)
        .withColumn("_entry", F.explode(sides))
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= per_side)
        .select("product_id", F.col("_entry.side").alias("side"), "rank", key, "leaning", "review_text")
    )
