from opinio.operators.reviews import extreme_reviews, last_user_text


def test_last_text_per_conversation(spark):
    rows = [
        ("user wins", 0, "user", "first"),
        ("user wins", 1, "user", "second"),
        ("user wins", 2, "assistant", "reply"),
        ("no user", 0, "system", "rules"),
        ("no user", 1, "assistant", "hello"),
        ("missing user text", 0, "assistant", "hello"),
        ("missing user text", 1, "user", None),
        ("all missing", 0, "assistant", None),
    ]
    messages = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    assert dict(last_user_text(messages).collect()) == {
        "user wins": "second",
        "no user": "hello",
        "missing user text": "",
        "all missing": "",
    }


def test_extremes_of_a_crowded_product(spark):
    reviews = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('P', id % 40)) AS product_id",
        "id",
        "if(id % 11 = 0, 'n/a', cast(1 + id % 5 AS string)) AS rating",
        "concat('text ', id) AS review_text",
    )
    got = {}
    for r in extreme_reviews(reviews.repartition(7)).collect():
        got.setdefault((r.product_id, r.side), {})[r["rank"]] = r.id
    groups = {}
    for r in reviews.collect():
        if r.rating != "n/a":
            groups.setdefault(r.product_id, []).append((int(r.rating), r.id))
    for product, found in groups.items():
        best = sorted(found, key=lambda x: (-x[0], x[1]))[:3]
        worst = sorted(found)[:3]
        assert got[product, "positive"] == {n + 1: i for n, (_, i) in enumerate(best)}
        assert got[product, "negative"] == {n + 1: i for n, (_, i) in enumerate(worst)}


def test_a_product_without_usable_ratings_has_no_extremes(spark):
    rows = spark.createDataFrame(
        [("P", 1, None, "t"), ("P", 2, "x", "t")],
        "product_id string, id long, rating string, review_text string",
    )
    assert extreme_reviews(rows).count() == 0


def test_reviews_judged_by_their_text(spark):
    import math
    from collections import Counter

    from opinio.operators.reviews import text_judged_reviews

    rows = [
        ("P", 1, "5", "lovely soft cream"), ("P", 2, "5", "lovely"), ("P", 3, "1", "awful sticky cream"),
        ("P", 4, "2", "awful awful"), ("P", 5, None, "lovely but sticky"), ("P", 6, "bad", "awful"),
        ("P", 7, "3", "cream"), ("Q", 8, "4", "soft"), ("Q", 9, "1", None), (None, 10, "5", "soft soft"),
    ]
    frame = spark.createDataFrame(rows, "product_id string, id int, rating string, review_text string")
    high, low = Counter(), Counter()
    vocabulary = set()
    for _, _, rating, text in rows:
        words = (text or "").split()
        vocabulary |= set(words)
        if rating in ("4", "5"):
            high.update(words)
        if rating in ("1", "2"):
            low.update(words)
    leaning = {
        w: math.log((high[w] + 1) / (high.total() + len(vocabulary)))
        - math.log((low[w] + 1) / (low.total() + len(vocabulary)))
        for w in vocabulary
    }
    want = {i: sum(leaning[w] for w in text.split()) for _, i, _, text in rows if text}
    got = text_judged_reviews(frame, 2).collect()
    assert all(abs(r.leaning - want[r.id]) < 2e-6 for r in got)
    for product in ("P", "Q", None):
        mine = sorted((i for p, i, _, t in rows if p == product and t), key=lambda i: (-round(want[i], 6), i))
        up = [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.product_id == product and r.side == "positive"]
        assert up == mine[:2]
    assert len(got) == 2 * (2 + 1 + 1)
    assert text_judged_reviews(frame.limit(0)).count() == 0
