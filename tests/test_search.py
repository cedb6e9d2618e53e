import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_text import bucket, words

from opinio.operators import search
from opinio.operators.index import TextIndex
from opinio.session import new_path
from opinio.sources import standins


@pytest.fixture(scope="module")
def corpus(spark, data):
    index = TextIndex(spark, new_path(spark, "index")).build(standins.corpus(spark, data))
    texts = {r.id: r.review_text for r in standins.corpus(spark, data).collect()}
    queries = {r.query_id: r.query_text for r in standins.questions(spark, data).collect()}
    return index, texts, queries


def ask(spark, queries):
    return spark.createDataFrame(list(queries.items()), "query_id long, query_text string")


def bm25(texts, query):
    docs = {i: Counter(words(t)) for i, t in texts.items()}
    mean = sum(sum(d.values()) for d in docs.values()) / len(docs)
    df = Counter(term for d in docs.values() for term in d)
    scores = {}
    for i, d in docs.items():
        total = 0.0
        for term in set(words(query)) & set(d):
            idf = math.log(1 + (len(docs) - df[term] + 0.5) / (df[term] + 0.5))
            tf = d[term]
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sum(d.values()) / mean))
        if total:
            scores[i] = round(total, 4)
    return scores


def hashed_cosine(texts, query):
    def vector(text):
        counts = Counter(bucket(t) for t in words(text))
        norm = math.sqrt(sum(n * n for n in counts.values()))
        return {b: n / norm for b, n in counts.items()} if counts else {}

    q = vector(query)
    scores = {}
    for i, text in texts.items():
        v = vector(text)
        total = sum(w * v.get(b, 0.0) for b, w in q.items())
        if total:
            scores[i] = total
    return scores


def best(scores, k):
    return sorted(scores, key=lambda i: (-scores[i], i))[:k]


def hits(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
    return out


@pytest.mark.parametrize("bounds", [{}, {"resident_queries": 9, "items_per_block": 40}])
def test_fulltext_equals_plain_bm25(spark, corpus, bounds):
    index, texts, queries = corpus
    got = hits(search.search_fulltext(index.current(), ask(spark, queries), 5, **bounds))
    for number, query in queries.items():
        scores = bm25(texts, query)
        assert [i for i, _ in got.get(number, [])] == best(scores, 5)
        for i, score in got.get(number, []):
            assert math.isclose(score, scores[i], abs_tol=1.1e-4)


def test_few_terms_take_the_pushed_filter(spark, corpus):
    index, texts, queries = corpus
    query = " ".join(words(next(iter(queries.values())))[:2])
    found = search.search_fulltext(index.current(), ask(spark, {1: query}), 4)
    assert "PushedFilters: [In(term" in found._jdf.queryExecution().toString()
    assert [i for i, _ in hits(found)[1]] == best(bm25(texts, query), 4)


@pytest.mark.parametrize("bounds", [{}, {"resident_queries": 9, "items_per_block": 40}])
def test_semantic_equals_plain_cosine(spark, corpus, bounds):
    index, texts, queries = corpus
    got = hits(search.search_semantic(index.current(), ask(spark, queries), 3, **bounds))
    for number, query in queries.items():
        scores = hashed_cosine(texts, query)
        top = best(scores, 3)
        for (i, score), j in zip(got[number], top, strict=True):
            assert math.isclose(score, scores[i], abs_tol=2e-6)
            assert math.isclose(scores[i], scores[j], abs_tol=2e-6)


def test_hybrid_adds_reciprocal_ranks(spark, corpus):
    index, _, queries = corpus
    asked = ask(spark, queries)
    near = hits(search.search_semantic(index.current(), asked, 50))
    worded = hits(search.search_fulltext(index.current(), asked, 50))
    got = hits(search.search(index, asked, 5, "hybrid"))
    for number in queries:
        votes = Counter()
        for ranking in (near, worded):
            for place, (i, _) in enumerate(ranking.get(number, []), 1):
                votes[i] += 1 / (60 + place)
        assert [i for i, _ in got[number]] == best(votes, 5)


@pytest.mark.parametrize("mode", search.MODES)
def test_empty_queries_hit_nothing(spark, corpus, mode):
    index = corpus[0]
    queries = spark.createDataFrame([(1, ""), (2, "?!"), (3, None)], "query_id long, query_text string")
    assert search.search(index, queries, 3, mode).count() == 0
    assert search.search(index, queries.limit(0), 3, mode).count() == 0


def test_unknown_words_hit_nothing(spark, corpus):
    asked = ask(spark, {1: "xqzzyjkw"})
    assert search.search(corpus[0], asked, 3, "fulltext").count() == 0


@pytest.mark.parametrize("mode", search.MODES)
def test_hits_bring_the_wanted_columns(spark, corpus, mode):
    index, texts, queries = corpus
    found = search.search(index, ask(spark, queries), 2, mode, ["review_text", "lang"])
    assert found.columns == ["query_id", "rank", "id", "score", "review_text", "lang"]
    for row in found.collect():
        assert texts[row.id] == row.review_text


def test_contexts_cite_rows_of_the_index(spark, corpus):
    index, texts, queries = corpus
    asked = ask(spark, {**queries, 999: ""})
    rows = search.question_context(index, asked, 3).collect()
    assert {r.query_id for r in rows} == set(queries) | {999}
    plain = hits(search.search(index, asked, 3, "hybrid"))
    for row in rows:
        assert [(c.id, c.score) for c in row.context] == plain.get(row.query_id, [])
        assert all(texts[c.id] == c.text for c in row.context)


def test_copies_of_one_text_rank_by_id(spark):
    rows = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "lovely cream")
        .otherwise(F.concat(F.lit("other words "), F.col("id")))
        .alias("review_text"),
    )
    index = TextIndex(spark, new_path(spark, "index")).build(rows)
    asked = ask(spark, {1: "lovely cream"})
    for mode in search.MODES:
        found = search.search(index, asked, 4, mode).orderBy("rank")
        assert [r.id for r in found.collect()] == [0, 3, 6, 9]


def test_search_follows_a_sync(spark):
    rows = "id long, review_text string"
    index = TextIndex(spark, new_path(spark, "index"))
    index.sync(spark.createDataFrame([(1, "awkward brush"), (2, "useless thing")], rows))
    asked = ask(spark, {1: "Awkward, useless"})
    assert {r.id for r in search.search(index, asked, 3, "fulltext").collect()} == {1, 2}
    index.sync(spark.createDataFrame([(1, "lovely brush"), (3, "awkward")], rows))
    for mode in ("fulltext", "semantic"):
        assert [r.id for r in search.search(index, asked, 1, mode).collect()] == [3]


def test_hybrid_is_at_least_as_deep_as_asked(spark):
    rows = [(i, f"cream number{i}") for i in range(120)]
    index = TextIndex(spark, new_path(spark, "index")).build(
        spark.createDataFrame(rows, "id long, review_text string")
    )
    asked = spark.createDataFrame([(1, "cream")], "query_id int, query_text string")
    assert search.search(index, asked, 100, "hybrid").count() == 100
    assert search.search(index, asked, 3, "hybrid", depth=5).count() == 3


def test_a_callers_model_ranks_negative_cosines(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    @F.pandas_udf("array<float>")
    def sides(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [1.0, 0.1] if "up" in t else [-1.0, 0.1])

    rows = [(1, "up one"), (2, "down two"), (3, "down three")]
    index = TextIndex(spark, new_path(spark, "index"), embed=sides).build(
        spark.createDataFrame(rows, "id long, review_text string")
    )
    asked = spark.createDataFrame([(1, "up")], "query_id int, query_text string")
    assert [r.id for r in search.search(index, asked, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_a_frequent_term_reads_under_half_its_postings(spark):
    import random

    rng = random.Random(2)
    texts = {
        i: " ".join(["cream"] * rng.choice([0, 0, 1, 1, 1, 1, 2, 6]) + [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 30))])
        for i in range(6000)
    }
    index = TextIndex(spark, new_path(spark, "index"), n_buckets=2).build(ask(spark, texts).toDF("id", "review_text"))
    found = index.current()
    for queries in ({1: "cream"}, {1: "cream", 2: "cream w7", 3: "w1 w2 w3 cream", 4: "none"}):
        asked = ask(spark, queries)
        got = hits(search.search_fulltext(found, asked, 5))
        for number, query in queries.items():
            scores = bm25(texts, query)
            assert [i for i, _ in got.get(number, [])] == best(scores, 5)
    terms = ask(spark, {1: "cream"}).select("query_id", F.array(F.lit("cream")).alias("terms"))

    def ranked(blocks):
        from opinio.operators.topk import exact_topk, weighted_terms_scorer

        return exact_topk(search._matches(found, blocks), terms, weighted_terms_scorer, 5, 4, F.lit(8))

    read = search.needed_blocks(found, terms, 5, ranked)
    n_cream = sum("cream" in words(t) for t in texts.values())
    assert 5 <= read.agg(F.sum("n")).first()[0] < n_cream / 2
    assert "PushedFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    # the bound of the last block needed has reached the scan
    assert "LessThanOrEqual(block" in read._jdf.queryExecution().executedPlan().toString()


def test_hits_prune_the_rows_partitions(spark, corpus):
    index, _, queries = corpus
    found = search.search(index, ask(spark, dict(list(queries.items())[:2])), 2, "fulltext", ["lang"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert {r.lang for r in found.collect()} <= {"en", "de", "es", "fr", None, "und"}
