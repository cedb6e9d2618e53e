import pytest

from opinio.operators import ratings


def frame(spark, per_product):
    rows = [(product, str(r)) for product, given in per_product.items() for r in given]
    return spark.createDataFrame(rows, "product_id string, rating string")


def mixed(n):
    return [1, 5] + [3] * (n - 2)


def test_unusable_ratings_count_for_nothing(spark):
    rows = spark.createDataFrame(
        [("P", "abc"), ("P", ""), ("P", None), ("P", "4"), ("Q", "x")],
        "product_id string, rating string",
    )
    got = {r.product_id: tuple(r)[1:] for r in ratings.rating_stats(rows).collect()}
    assert got == {"P": (1, 4.0, 4.0, 4.0), "Q": (0, None, None, None)}


def test_numeric_ratings_pass_the_cast(spark):
    rows = spark.createDataFrame([("P", 4), ("P", 5)], "product_id string, rating int")
    assert ratings.rating_stats(rows).first().rating_avg == 4.5


def test_review_count_bounds_are_inclusive(spark):
    rows = frame(spark, {str(n): mixed(n) for n in (29, 30, 50, 51)})
    got = ratings.polarised(ratings.rating_stats(rows)).select("product_id").collect()
    assert sorted(r[0] for r in got) == ["30", "50"]


def test_a_tie_goes_to_the_lower_id(spark):
    rows = frame(spark, {"B": mixed(30), "A": mixed(30), "C": [1, 5] + [4] * 28})
    assert ratings.most_divisive(rows).collect()[0][0] == "A"
    order = [r.product_id for r in ratings.ranked(
        ratings.divisiveness(ratings.rating_stats(rows))).collect()]
    assert order == ["A", "B", "C"]


@pytest.mark.parametrize("make", [ratings.gold, ratings.gold_by_join])
def test_gold_keeps_all_rows_of_the_product(spark, make):
    rows = frame(spark, {"A": mixed(31), "B": [1, 5] + [5] * 40, "HOT": mixed(2000)})
    found = make(rows)
    assert found.columns == rows.columns
    assert {r.product_id for r in found.collect()} == {"A"}
    assert found.count() == 31


@pytest.mark.parametrize("make", [ratings.gold, ratings.gold_by_join])
def test_no_qualifying_product_gives_no_rows(spark, make):
    assert make(frame(spark, {"A": [3] * 40})).count() == 0


def test_the_rule_is_a_parameter(spark):
    rule = ratings.Selection(min_reviews=2, max_reviews=3)
    rows = frame(spark, {"A": mixed(2), "B": mixed(40)})
    assert {r.product_id for r in ratings.gold(rows, rule).collect()} == {"A"}
