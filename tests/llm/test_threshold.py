from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import threshold
from opinio.llm.common import table
from opinio.llm.queries import op10_top_k


def brute(rows, k, asks):
    used = [
        (i, v, [math.floor(1024 * x) for x in e])
        for i, (v, e) in enumerate(rows)
        if v is not None and e and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, q, a in used:
        if asks(q):
            scores = sorted(
                (-sum(x * y for x, y in zip(a, b)), v)
                for j, v, b in used
                if j != i and len(a) == len(b)
            )
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(scores[:k])]
    return sorted(out)


def test_lists_stop_early_and_keep_every_possible_row():
    rng = np.random.default_rng(0)
    centre = rng.normal(0, 300, (20, 16))
    matrix = np.floor(centre[rng.integers(0, 20, 2000)] + rng.normal(0, 20, (2000, 16))).astype(np.int64)
    shard, sizes = threshold.Shard(matrix), []
    for i in range(30):
        rows = shard.candidates(matrix[i], 10, i)
        sizes.append(len(rows))
        scores = matrix @ matrix[i]
        scores[i] = np.iinfo(np.int64).min
        kth = np.sort(scores)[-10]
        assert set(np.flatnonzero(scores >= kth)) <= set(rows.tolist())
    assert np.mean(sizes) < 200


def test_query_equals_brute_force(spark, data):
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, data, "embeddings").collect()]
    got = sorted(tuple(r) for r in op10_top_k(spark, data).collect())
    assert got == brute(rows, 10, lambda v: v % 100 == 0)


def test_odd_rows_and_many_blocks(spark):
    rng = np.random.default_rng(4)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(150)]
    rows += [(0, rows[0][1]), (7, rows[7][1]), (1000, [1.0, None, 0.0, 0.0]), (1010, [nan, 0.0, 0.0, 0.0])]
    rows += [(1020, [inf, 0.0, 0.0, 0.0]), (1030, None), (1040, []), (None, [1.0] * 4), (1050, [1.0, 2.0])]
    rows += [(1060, [0.0] * 4)]
    frame = spark.createDataFrame(
        [(v, e, "x") for v, e in rows], "vec_id bigint, embedding array<float>, score string"
    )
    want = brute(rows, 5, lambda v: v % 10 == 0)
    for shard, queries in ((10_000, 1000), (20, 4)):
        got = threshold.top_k(frame, F.col("vec_id") % 10 == 0, 5, shard=shard, queries=queries)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert threshold.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_large_components_take_part(spark):
    rng = np.random.default_rng(6)
    for kind, size in (("float", 5_000.0), ("float", 3e5), ("double", 3e5)):
        rows = [(i, (size * rng.normal(size=4)).astype(np.float32).tolist()) for i in range(700)]
        # sums with these need more than 64 bits, or more than doubles hold
        rows += [(701, [-1e20, 0.0, 0.0, 0.0]), (702, [0.0, 0.0, 0.0, 0.0])] if size > 5_000 else []
        rows += [(703, [-1e308, 0.0, 0.0, 0.0])] if kind == "double" else []
        rows = [(v, [abs(e[0]), *e[1:]] if v < 700 else e) for v, e in rows]
        frame = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
        if kind == "float":
            rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
        asks = lambda v: v % 100 == 0
        got = threshold.top_k(frame, F.col("vec_id") % 100 == 0, 5, shard=500)
        exact = [(v, [x if abs(x) < 1e300 else int(x) for x in e]) for v, e in rows]
        want = []
        for q, a in exact:
            if asks(q):
                scores = sorted(
                    (-sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b)), v)
                    for v, b in exact
                    if v != q
                )
                want += [(q, n + 1, v, -s) for n, (s, v) in enumerate(scores[:5])]
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_a_score_beyond_a_bigint_is_an_error_and_not_a_wrong_number(spark):
    frame = spark.createDataFrame([(0, [1e20]), (1, [1e20])], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="too large for a bigint"):
        threshold.top_k(frame, F.col("vec_id") == 0, 1).collect()
