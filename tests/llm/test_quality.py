from __future__ import annotations

import zlib

import numpy as np

from opinio.llm import quality
from opinio.llm.common import table
from opinio.llm.queries import op2_quality

WORDS = "good calm plain words about rivers trees houses people and weather today".split()


def clean(rng, n):
    return " ".join(rng.choice(WORDS, n))


def junk(rng, n):
    return " ".join(w.upper() + "!!" for w in rng.choice(WORDS, n))


def samples(n=60):
    rng = np.random.default_rng(3)
    return [(f(rng, 40).encode(), y) for _ in range(n) for f, y in ((clean, 1), (junk, 0))]


def net():
    return quality.train(*map(list, zip(*samples())))


def test_every_byte_is_in_a_window_and_every_window_in_a_chunk():
    for n in (0, 1, 7, 8, 9, 1000, 4097):
        codes = np.arange(n, dtype=np.uint64).astype(np.uint8)
        seen = quality.windows(codes)
        covered = {s * quality.STEP + w for s in range(len(seen)) for w in range(quality.WIDTH)}
        assert set(range(n)) <= covered
        spans = quality.chunk_spans(len(seen))
        assert {i for a, b in spans for i in range(a, b)} == set(range(len(seen)))


def test_parts_of_a_long_text_give_the_same_responses(monkeypatch):
    model = net()
    text = (clean(np.random.default_rng(1), 3000)).encode()
    whole = quality.responses(model, text)
    monkeypatch.setattr(quality, "AT_ONCE", 2 * quality.UNIT * quality.STEP)
    parts = quality.responses(model, text)
    assert np.allclose(whole[0], parts[0], atol=1e-4) and np.array_equal(whole[1], parts[1])


def test_junk_is_told_from_clean_text_wherever_it_stands():
    model, rng = net(), np.random.default_rng(9)
    assert quality.score(model, clean(rng, 50).encode()) > 0.8
    assert quality.score(model, junk(rng, 50).encode()) < 0.2
    long = clean(rng, 20).encode() + b" " + junk(rng, 20_000).encode()
    assert quality.score(model, long) < 0.2


def test_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "x"), (3, "word " * 60_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    model = net()
    got = quality.scores(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert got[0].score == got[1].score and got[2].score == got[3].score
    kept = quality.keep_good(docs, model, threshold=0.0)
    assert kept.schema == docs.schema and kept.count() == 5
    assert quality.scores(docs.limit(0), model).count() == 0


def test_labels_that_are_missing_or_disagree(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (None, 1), (3, None), (9, 0)], "doc_id bigint, quality int"
    )
    model = quality.fit(docs, labels)  # label 1 alone is left
    assert quality.score(model, b"") == quality.score(model, b"anything") > 0.5
    assert quality.score(quality.fit(docs, labels.limit(0)), b"") == 0.5


def test_query_on_held_out_rows(spark, data):
    truth = {r.doc_id: r.quality for r in table(spark, data.replace("sf0.001", "sf0.01"), "labels").collect()}
    rows = op2_quality(spark, data.replace("sf0.001", "sf0.01")).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.85


def test_scores_equal_a_plain_convolution():
    model, rng = net(), np.random.default_rng(5)
    texts = [b"", b"a", clean(rng, 3).encode(), clean(rng, 400).encode(), junk(rng, 90).encode() + bytes(range(256))]
    for text in texts:
        codes = list(text) + [0] * quality.WIDTH
        n = max(1, -(-len(text) // quality.STEP))
        evidence = []
        for a, b in quality.chunk_spans(n):
            best = [-np.inf] * quality.FILTERS
            for w in range(a, b):
                seen = np.concatenate([model.vectors[c] for c in codes[w * quality.STEP :][: quality.WIDTH]])
                best = np.maximum(best, [seen @ model.filters[:, f] for f in range(quality.FILTERS)])
            active = np.maximum(best + model.bias, 0)
            evidence.append(active @ model.weights[:-1] + np.log2(b - a) * model.weights[-1])
        value = np.clip(np.mean(evidence) + model.offset, -30, 30)
        assert abs(quality.score(model, text) - 1 / (1 + np.exp(-value))) < 1e-5


def test_the_end_of_a_long_text_is_learned(monkeypatch):
    rng = np.random.default_rng(8)
    start = clean(rng, 600).encode()
    texts = [(start + b" " + f(rng, 600).encode(), y) for _ in range(30) for f, y in ((clean, 1), (junk, 0))]
    monkeypatch.setattr(quality, "CHUNKS_AT_ONCE", 7)  # parts of a batch change nothing that counts
    model = quality.train(*map(list, zip(*texts)))
    assert quality.score(model, texts[0][0]) > 0.7 and quality.score(model, texts[1][0]) < 0.3


def test_columns_of_any_name_pass_through(spark):
    rows = [(1, clean(np.random.default_rng(1), 40), "mine", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _quality string, score int")
    assert [tuple(r) for r in quality.keep_good(docs, net()).collect()] == rows
