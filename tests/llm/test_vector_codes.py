from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from opinio.llm import vector_codes
from opinio.llm.common import table
from opinio.llm.queries import op13_vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, _key string, code int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [
        (k, [math.floor(scale * x) for x in v], label)
        for k, v, label, *_ in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    cuts = vector_codes.spans(len(kept[0][1]), parts)
    books = [[r[1][a:b] for r in kept[:entries]] for a, b in cuts]

    def nearest(v, p):
        a, b = cuts[p]
        return min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        chosen = [[nearest(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p, (a, b) in enumerate(cuts):
            for e in range(len(books[p])):
                own = [v[a:b] for (_, v, _), c in zip(kept, chosen) if c[p] == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = []
    for key, v, label in kept:
        best = [nearest(v, p) for p in range(parts)]
        found.append([key, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), label])
    total = {}
    for row in found:
        total[row[3]] = total.get(row[3], 0) + row[2]
    return sorted(((k, c, e, total[label], sha) for k, c, e, label in found), key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def vectors(n, width, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (5, width))
    return [
        (int(i), [float(x) for x in centres[i % 5] + rng.normal(0, spread / 8, width)], int(i) % 3 or None, "k", 1)
        for i in range(n)
    ]


def test_odd_rows_equal_brute_force(spark):
    rows = vectors(300, 16)
    rows += [(7, rows[7][1], 1, None, None), (7, rows[8][1], None, None, None), (None, rows[9][1], 2, None, None)]
    rows += [(400 + i, rows[3][1], 0, "hot", 0) for i in range(200)]
    rows += [(900, None, 1, "", 0), (901, [], 1, "", 0), (902, [float("nan")] * 16, 1, "", 0)]
    rows += [(903, [None] * 16, 1, "", 0), (904, [math.inf] + [0.0] * 15, 1, "", 0), (905, [1.0] * 8, 1, "", 0)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(vector_codes.encode(frame)) == brute(rows)


@pytest.mark.parametrize("width", [3, 10])
def test_parts_that_cannot_be_equal_and_few_vectors(spark, width):
    rows = vectors(9, width)
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, parts=4, rounds=3)
    assert got(vector_codes.encode(frame, parts=4, rounds=3)) == want


def test_large_components_are_exact(spark):
    rows = vectors(60, 8, spread=3e5) + [(100, [1e6] * 8, 1, "", 0)]
    assert got(vector_codes.encode(spark.createDataFrame(rows, SCHEMA), entries=60, rounds=2)) == brute(rows, entries=60, rounds=2)
    far = [(i, [1e300 * (i % 2 or -1)] * 8, 1, "", 0) for i in range(40)]
    assert got(vector_codes.encode(spark.createDataFrame(far, SCHEMA), rounds=2)) == brute(far, rounds=2)


def test_empty_table_and_no_rounds(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_codes.encode(none).count() == 0
    rows = vectors(40, 8)
    assert got(vector_codes.encode(spark.createDataFrame(rows, SCHEMA), rounds=0)) == brute(rows, rounds=0)


def test_bounds_spare_scans_and_net_moves_are_tighter_than_their_sum():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    values = centres[rng.integers(0, 16, 5000)] + rng.integers(-400, 400, (5000, 8))
    books, state, scans = vector_codes.Books(), None, []
    book = values[:16].copy()
    for _ in range(12):
        books.rounds.append([book])
        state, scanned = vector_codes.assigned(values, books, 0, state)
        scans.append(scanned)
        want = ((values[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (state.label == want).all()
        book = np.array([values[want == i].sum(axis=0) // max(1, (want == i).sum()) for i in range(16)])
    assert scans[0] == 5000 and scans[-1] < 1000
    # an entry that has come back has not moved
    to_and_fro = vector_codes.Books([[b] for b in (book, book + 50, book)])
    assert to_and_fro.moved(0, 0).max() == 0 and to_and_fro.moved(0, 1).min() > 100


def test_query_over_the_table(spark, data):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, data, "embeddings").collect()]
    assert got(op13_vector_codes(spark, data)) == brute(rows)
