import hashlib

import numpy as np
from test_text import words

from opinio.operators import meaning
from opinio.operators.index import TextIndex
from opinio.operators.search import search
from opinio.session import new_path


def matrix(texts, buckets):
    counts = np.zeros((len(texts), buckets))
    for row, text in enumerate(texts):
        for term in words(text):
            counts[row, int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % buckets] += 1
    return counts


def test_directions_reconstruct_nearly_as_well_as_the_best_ones(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet").select("text")
    basis = meaning.fit(documents.repartition(5), "text", buckets=512, rank=20)
    counts = matrix([r.text for r in documents.collect()], 512)
    counts = counts[counts.any(axis=1)]
    n, df = len(counts), (counts > 0).sum(axis=0)
    assert np.allclose(basis.idf, np.log((1 + n) / (1 + df)) + 1)
    x = meaning.weighted(counts, basis.idf)
    assert np.allclose(basis.directions.T @ basis.directions, np.eye(20), atol=1e-8)
    error = np.linalg.norm(x - x @ basis.directions @ basis.directions.T) ** 2
    singular = np.linalg.svd(x, compute_uv=False)
    assert error <= 1.03 * (singular[20:] ** 2).sum()
    assert np.allclose(basis.strengths[:5], singular[:5], rtol=0.02)


def test_a_text_is_found_by_words_it_does_not_have(spark):
    rng = np.random.default_rng(1)
    topics = [["cream", "lotion", "balm", "moisture"], ["brush", "comb", "bristle", "handle"]]
    rows = [(i, " ".join(rng.choice(topics[i % 2], 3, replace=False))) for i in range(200)]
    rows += [(900, "lotion balm moisture"), (901, ""), (902, None)]
    frame = spark.createDataFrame(rows, "id long, review_text string")
    basis = meaning.fit(frame, "review_text", buckets=256, rank=2)
    index = TextIndex(spark, new_path(spark, "index"), embed=basis.embed()).build(frame)
    asked = spark.createDataFrame([(1, "cream")], "query_id int, query_text string")
    hits = search(index, asked, 60, "semantic").collect()
    assert {r.id % 2 for r in hits if r.id < 900} == {0}
    stored = {r.id: r.embedding for r in index.current().rows().collect()}
    want = basis.vectors(matrix(["lotion balm moisture"], 256))[0]
    assert np.allclose(stored[900], want, atol=1e-6) and not any(stored[901]) and not any(stored[902])


def test_nothing_to_learn(spark):
    basis = meaning.fit(spark.createDataFrame([("",), (None,)], "t string"), "t", buckets=64, rank=4)
    assert not basis.directions.any() and basis.vectors(np.ones((1, 64))).shape == (1, 4)
