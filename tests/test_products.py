import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinio.operators import search, topk
from opinio.operators.index import TextIndex
from opinio.session import new_path

MATCH = pa.struct([("term", pa.string()), ("weight", pa.float64())])


def tables(least):
    rng = np.random.default_rng(7)
    odds = 1 / (1 + np.arange(300)) ** 0.7
    rows = [
        [(f"t{t}", float(rng.uniform(least, 3.0))) for t in np.flatnonzero(rng.random(300) < odds)]
        for _ in range(500)
    ]
    rows += rows[:200] + [[], [("t0", 1e-40)]]
    items = pa.table({"id": pa.array(range(len(rows))), "matches": pa.array(rows, pa.list_(MATCH))})
    asked = [[f"t{t}" for t in rng.choice(400, rng.integers(0, 30), replace=False)] for _ in range(600)]
    asked += [["t0"], ["t399"], [f"t{t}" for t in range(300)]]
    return items, pa.table({"query_id": pa.array(range(len(asked))), "terms": pa.array(asked, pa.list_(pa.string()))})


@pytest.mark.parametrize("least", [0.1, -1.0])
@pytest.mark.parametrize("setting", [{}, {"PRODUCTS_A_POSTING": 0}, {"PRODUCTS_A_POSTING": 10**6}, {"POSTINGS_AT_ONCE": 50}])
def test_products_and_postings_give_the_best(monkeypatch, least, setting):
    for name, value in setting.items():
        monkeypatch.setattr(topk, name, value)
    items, queries = tables(least)
    score = topk.weighted_terms_scorer(queries)(items)
    whole = {q: (rows, scores) for q, rows, scores in score()}
    scored = sum(len(rows) for _, rows, _ in score(2, 4, None))
    assert least < 0 or scored < sum(len(rows) for rows, _ in whole.values()) / 20
    found = topk.block_hits(items, score, 2, 4)
    for q in range(queries.num_rows):
        rows, scores = whole.get(q, (np.empty(0, int), np.empty(0)))
        ranked = sorted((-topk.round_half_up(s, 4), r) for r, s in zip(rows.tolist(), scores) if s > -np.inf)[:2]
        got = found.filter(pa.array(found["query"].to_numpy() == q))
        assert got["id"].to_pylist() == [r for _, r in ranked]
        assert got["score"].to_pylist() == pytest.approx([-s for s, _ in ranked])


def test_few_tasks_score_all_buckets_and_a_question_is_analysed_once(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(12))) for i in range(400)]
    rows = spark.createDataFrame(texts, "id long, review_text string")
    found = TextIndex(spark, new_path(spark, "index"), n_buckets=4).build(rows).current()
    seen = spark.sparkContext.accumulator(0)

    def noted(text):
        seen.add(1)
        return text

    asked = spark.createDataFrame(texts[:50], "query_id long, query_text string").coalesce(1)
    noted_asked = asked.withColumn("query_text", F.udf(noted, "string")("query_text"))
    for find in (search.search_fulltext, search.search_semantic):
        monkeypatch.setattr(topk, "TASKS_A_CORE", 3)
        many = sorted(map(tuple, find(found, asked, 4).collect()))
        monkeypatch.setattr(topk, "TASKS_A_CORE", 0.125)
        seen.value = 0
        few = find(found, noted_asked, 4)
        assert sorted(map(tuple, few.collect())) == many
        assert seen.value == 50


def test_hits_of_few_tasks_are_ranked_in_one_step(spark, monkeypatch):
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(40)], "id long, embedding array<float>")
    asked = vectors.withColumnRenamed("id", "query_id")

    def ranked():
        found = search.semantic_topk(vectors.repartition(9), asked, 2)
        plan = found._jdf.queryExecution().executedPlan().toString()
        return plan.count("Window ["), sorted(map(tuple, found.collect()))

    once, hits = ranked()
    monkeypatch.setattr(topk, "RANKING_PARTS", 2)
    twice, same = ranked()
    assert (once, twice) == (1, 2)
    assert hits == same and len(hits) == 80
