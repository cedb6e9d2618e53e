from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from opinio.llm import importance
from opinio.llm.common import table
from opinio.llm.queries import op12_importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, shortest, longest):
    words = words_of(text)
    return [
        " ".join(words[i : i + n]).encode()
        for n in range(shortest, longest + 1)
        for i in range(len(words) - n + 1)
    ]


TEXTS = [
    "", " -- ", "a", "One two  three. FOUR five", "ÄÖ ß 水 é٣ x", "x" * 5000 + " " + "y" * 300_000 + " z",
    "a b " * 3000, "tab\tnew\nline\0nul",
]


@pytest.mark.parametrize("sizes", [(1, 1), (1, 3), (2, 5)])
def test_crcs_equal_those_of_the_spelled_grams(sizes):
    rng = random.Random(1)
    more = ["".join(rng.choice("aB c-é\n9") for _ in range(rng.randrange(200))) for _ in range(200)]
    texts = TEXTS + more
    crcs, counts, n_words = importance.feature_crcs([t.encode() for t in texts], *sizes)
    want = [[zlib.crc32(g) for g in grams(t, *sizes)] for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert n_words.tolist() == [len(words_of(t)) for t in texts]
    assert crcs.tolist() == [c for w in want for c in w]


def test_a_shift_is_what_appending_does_to_a_crc():
    rng = random.Random(2)
    for size in (0, 1, 63, 64, 65, 4095, 4096, 300_000):
        a, b = rng.randbytes(10), rng.randbytes(size)
        shifted = importance.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([size]))
        assert int(shifted[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def brute(docs, targets, buckets=10_000, shortest=1, longest=1, fewest=20, percent=10, seed=2024):
    def numbers(text):
        return [zlib.crc32(g) % buckets for g in grams(text, shortest, longest)]

    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in numbers(text):
            s[b] += 1
    for text in targets:
        for b in numbers(text):
            t[b] += 1
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
        for b in range(buckets)
    ] if docs else []
    rows = []
    for doc, text in docs:
        found = numbers(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, len(words_of(text))])
    able = [r for r in rows if r[5] >= fewest]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for n, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"longest": 2, "buckets": 97, "percent": 50}, {"percent": 100, "fewest_words": 0}])
def test_odd_rows_equal_brute_force(spark, options):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab cd the zebra q".split()) for _ in range(rng.randrange(60)))) for i in range(120)]
    docs += [(None, None), (None, "w " * 30), (5, "copy " * 30), (5, "copy " * 30), (900, None), (901, "")]
    docs += [(1000 + i, "hot copy " * 20) for i in range(80)]
    targets = ["the zebra", None, "", "zebra " * 40]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, _doc string, score int")
    wanted = spark.createDataFrame([(t, 7) for t in targets], "text string, _text int")
    names = {"fewest_words": "fewest"}
    want = brute(docs, targets, **{names.get(k, k): v for k, v in options.items()})
    assert got(importance.resample(frame, wanted, **options)) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id bigint, text string")
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    assert got(importance.resample(docs, none, percent=50)) == brute([(1, "a " * 30), (2, None)], [], percent=50)


def test_query_over_the_table(spark, data, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    targets = [r.text for r in table(spark, data, "benchmark").collect()]
    assert got(op12_importance(spark, data)) == brute(docs, targets)
