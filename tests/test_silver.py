from collections import Counter

from pyspark.sql import functions as F

from opinio.functions.rows import fingerprint
from opinio.operators.silver import id_check, join_reviews, with_stable_id, with_surrogate_id
from opinio.session import checked_broadcast

PRODUCTS = (
    "product_id string, product_name string, primary_category string, secondary_category string,"
    " tertiary_category string, highlights string, brand string"
)
REVIEWS = (
    "product_id string, rating string, is_recommended double, review_text string,"
    " price_usd double, author string"
)


def silver(spark):
    products = spark.createDataFrame(
        [(p, f"name {p}", "a", "b", None, None, "x") for p in ("P1", "P2", "P3", None)], PRODUCTS
    )
    reviews = spark.createDataFrame(
        [
            ("P1", "5", 1.0, "good", 9.5, "u"),
            ("P1", "1", 0.0, "bad", 9.5, "v"),
            ("P2", None, None, None, None, "w"),
            ("P9", "3", 0.0, "orphan", 1.0, "x"),
            (None, "3", 0.0, "no key", 1.0, "y"),
        ],
        REVIEWS,
    )
    return join_reviews(products, reviews)


def test_join_drops_orphans_and_null_keys(spark):
    rows = silver(spark)
    assert rows.columns == [
        "product_id", "product_name", "primary_category", "secondary_category",
        "tertiary_category", "highlights", "rating", "is_recommended", "review_text", "price_usd",
    ]
    assert Counter(r.product_id for r in rows.collect()) == {"P1": 2, "P2": 1}


def test_surrogate_ids_are_unique(spark):
    rows = with_surrogate_id(spark.range(10_000).repartition(16).select(F.lit(1).alias("x")))
    assert tuple(id_check(rows).first()) == (10_000, 10_000)


def test_stable_ids_do_not_depend_on_the_run(spark):
    first = with_stable_id(silver(spark))
    second = with_stable_id(silver(spark).repartition(5).orderBy("price_usd"))
    assert sorted(map(tuple, first.collect()), key=str) == sorted(
        map(tuple, second.collect()), key=str
    )


def test_a_row_repeated_in_a_third_of_the_input_is_numbered_in_ranges(spark):
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("r"), F.col("id") % 50))
        .alias("text"),
        F.lit(None).cast("double").alias("price"),
    )
    want = Counter(r.text for r in rows.collect())
    for options in ({}, {"copies_at_once": 7}, {"copies_at_once": 7, "ranges_per_row": 11}):
        numbered = with_stable_id(rows, **options)
        ids = {}
        for row in numbered.collect():
            ids.setdefault(row.text, set()).add(row.id)
        assert {text: len(found) for text, found in ids.items()} == want
        for text, found in ids.items():
            assert {int(i.split("-")[1]) for i in found} == set(range(1, want[text] + 1))
            assert len({i.split("-")[0] for i in found}) == 1
        spread = numbered.where("text = 'same'").select(F.spark_partition_id()).distinct().count()
        assert options == {} or spread > 1


def test_fingerprints_keep_field_borders_and_nulls_apart(spark):
    rows = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("-", "abc"), ("abc", None)],
        "x string, y string",
    )
    assert rows.select(fingerprint(rows, ["x", "y"])).distinct().count() == 6
    nested = spark.sql("SELECT array(1, 2) AS a, named_struct('b', 1) AS s")
    assert len(nested.select(fingerprint(nested, ["a", "s"])).first()[0]) == 32


def test_keys_are_broadcast_up_to_the_bound(spark):
    big, keys = spark.range(100), spark.range(5)
    for most, hinted in ((5, True), (4, False)):
        plan = big.join(checked_broadcast(keys, 5, most), "id")._jdf.queryExecution().toString()
        assert ("strategy=broadcast" in plan) is hinted


def test_a_hot_product_is_split_by_the_join(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1kb",
    }
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        products = spark.range(400).selectExpr(
            "id AS product_id", "concat('n', id) AS product_name", "'a' AS primary_category",
            "'b' AS secondary_category", "'c' AS tertiary_category", "'d' AS highlights",
        )
        reviews = spark.range(60_000).repartition(8).selectExpr(
            "if(id % 3 = 0, 7, id % 400) AS product_id", "'5' AS rating", "1.0D AS is_recommended",
            "sha2(cast(id AS string), 256) AS review_text", "1.0D AS price_usd",
        )
        joined = join_reviews(products, reviews)
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for name in changed:
            spark.conf.unset(name)


def test_a_stray_text_key_drops_out(spark):
    products = spark.createDataFrame(
        [(1, "Mask", "a", "b", "c", "d")],
        "product_id int, product_name string, primary_category string, secondary_category string,"
        " tertiary_category string, highlights string",
    )
    reviews = spark.createDataFrame(
        [("1", "5", 1.0, "fine", 2.0), ('tail of a broken line"', "4", 1.0, "x", 2.0)],
        "product_id string, rating string, is_recommended double, review_text string,"
        " price_usd double",
    )
    joined = join_reviews(products, reviews)
    assert joined.schema["product_id"].dataType.simpleString() == "int"
    assert [(r.product_id, r.review_text) for r in joined.collect()] == [(1, "fine")]
    assert join_reviews(reviews_as_products(products), reviews).count() == 1


def reviews_as_products(products):
    return products.withColumn("product_id", F.col("product_id").cast("string"))


def test_row_marks_do_not_depend_on_the_time_zone(spark):
    rows = spark.sql("SELECT timestamp'2024-03-01 12:00:00 UTC' AS at, 1 AS x")
    zone = spark.conf.get("spark.sql.session.timeZone")
    first = rows.select(fingerprint(rows, rows.columns)).first()[0]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert rows.select(fingerprint(rows, rows.columns)).first()[0] == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rows_without_a_copy_are_numbered_where_they_are(spark):
    rows = spark.range(5000).selectExpr("concat('text ', id) AS text", "id % 7 AS copies", "'m' AS mark")
    numbered = with_stable_id(rows)
    found = numbered.collect()
    assert len({r.id for r in found}) == 5000 and all(r.id.endswith("-1") for r in found)
    # rows meet a broadcast list, and as run none has crossed an exchange: there are no copies
    logical = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in logical and "rightHint=(strategy=broadcast)" in logical
    plan = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning" not in plan
    assert numbered.columns == ["text", "copies", "mark", "id"]
