from __future__ import annotations


import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from opinio.llm import dedup, packing, pii, simhash
from opinio.llm.common import table
from tests.llm.test_decontaminate import ITEM
from tests.llm.test_simhash import brute_components, brute_print


def check_kept(texts, kept):
    """Exactly one of each component of fingerprints within 2 bits, the first."""
    prints = [brute_print(t) for t in texts]
    groups = brute_components(list(range(len(texts))), prints, 2)
    assert sorted(kept) == sorted(set(groups))


def near_copies(n=40, seed=2):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(n):
        base = rng.choice(words, int(rng.integers(5, 160))).tolist()
        for _ in range(int(rng.integers(1, 7))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(len(copy)))] = str(rng.choice(words))
            texts.append(" ".join(copy))
    return texts


def test_near_dedup_equals_brute_force(spark):
    texts = near_copies() + ["", None, " \n", "one two", "ONE two", "one two three"]
    docs = spark.createDataFrame(
        [(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, uid string, f0 string"
    )
    kept = dedup.one_of_each(docs)
    assert kept.schema == docs.schema
    rows = kept.collect()
    check_kept(texts, [r.doc_id for r in rows])
    assert len(rows) < len(texts) and {(r.uid, r.f0) for r in rows} == {("x", "y")}


def test_repeated_rows_and_null_ids_leave_one(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "other words here"), (None, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(map(str, (r.doc_id for r in dedup.one_of_each(docs).collect())))
    assert kept == ["4", "None"]
    assert dedup.one_of_each(docs.limit(0)).count() == 0


def test_every_stage_on_the_table(spark, data, documents):
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, data)
        if name != "packing":
            assert docs.columns == documents.columns
            docs = docs.persist()
        seen[name] = (before, docs)
    before, after = seen["near_dedup"]
    rows = before.orderBy("doc_id").collect()
    keep = {r.doc_id for r in after.collect()}
    check_kept([r.text for r in rows], [i for i, r in enumerate(rows) if r.doc_id in keep])
    before, after = seen["pii"]
    assert after.count() == before.count()
    left = pii.find_spans(after, out="found").where(F.exists("found", lambda s: s["kind"].isin("email", "ip", "phone")))
    assert left.count() == 0
    before, after = seen["packing"]
    total = after.agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert total[1] == before.count()
    assert total[0] == after.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    whole = corpus_pipeline.run(spark, data)
    assert whole.columns == after.columns and whole.count() == after.count()


def test_decontamination_stage_drops_leaks(spark, data, documents):
    bench = table(spark, data, "benchmark").limit(1).first().text
    extra = spark.createDataFrame(
        [(-1, "before " + bench.upper() + " after", "en", "s", 1), (-2, ITEM, "en", "s", 1)], documents.schema
    )
    kept = corpus_pipeline.decontamination(spark, extra, data)
    assert [r.doc_id for r in kept.collect()] == [-2]
