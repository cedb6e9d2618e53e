from __future__ import annotations

import random

import pytest

from opinio.llm import decontaminate as D
from opinio.llm.common import table
from opinio.llm.queries import op9_decontaminate

ITEM = (
    "The quick brown fox jumps over the lazy dog near the old river bank while seven small "
    "children watch the boats, and nobody says a word about the strange weather of that day."
)


def distance(window: bytes, text: bytes) -> int:
    """Fewest edits between a window and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1))
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        i = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[i] = rng.choice("xyz")
        elif kind == 1:
            text.insert(i, rng.choice("xyz"))
        else:
            del text[i]
    return "".join(text)


@pytest.mark.parametrize("seed", range(40))
def test_nothing_within_the_budget_is_missed(seed):
    rng = random.Random(seed)
    words = ITEM.lower().split()
    noise = " ".join(rng.choice(words)[::-1] for _ in range(rng.choice([0, 5, 60])))
    text = D.fold(f"{noise} {edited(rng, ITEM, rng.randrange(0, 14))} {noise}".encode())
    windows = D.cut_windows([(1, D.fold(ITEM.encode()))])
    want = [
        (distance(w, text), b) for w, b in zip(windows.texts, windows.budgets.tolist())
    ]
    found = D.regions(windows, text)
    assert bool(found) == any(d <= b for d, b in want)
    if found:
        assert found[1][2] == min(d for d, b in want if d <= b)
        assert found[1][3] == sum(d <= b for d, b in want)


def test_places_follow_code_points():
    text = "  É😀x…,, Foo!\n\nbar. "
    folded = D.fold(text.encode())
    at = D.places(text.encode())
    assert len(at) == len(folded)
    assert [text[i] for i in at[-3:]] == list("bar")


def frames(spark):
    rows = [
        (1, "intro. " + ITEM.upper() + " outro", "a"), (2, "nothing of the kind here", "b"),
        (2, "nothing of the kind here", "b"), (None, None, None), (3, "", "c"),
        (4, "filler words " * 20_000 + ITEM + " filler words" * 20_000, "d"), (1, "x " + ITEM, "a"),
        (5, " ".join(ITEM.split()[:10]), "e"), (6, "tiny", "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(
        [(7, ITEM), (7, ITEM), (None, "null id of an item that is long enough"), (8, None), (9, "tiny")],
        "item_id bigint, text string",
    )
    return docs, bench


def test_odd_rows(spark):
    docs, bench = frames(spark)
    rows = D.find_passages(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in rows) == [(1, 7, 0), (1, 7, 0), (4, 7, 0), (6, 9, 0)]
    long = next(r for r in rows if r.doc_id == 4)
    text = "filler words " * 20_000 + ITEM
    assert text[long.start : long.end] == ITEM.rstrip(".")
    kept = D.clean_documents(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "3", "5", "None"]


def test_no_rows_on_either_side(spark):
    docs, bench = frames(spark)
    assert D.find_passages(docs.limit(0), bench).count() == 0
    assert D.find_passages(docs, bench.limit(0)).count() == 0
    assert D.clean_documents(docs, bench.limit(0)).count() == docs.count()


def test_blocks_of_the_benchmark_together_find_the_same(spark, data, documents):
    bench = table(spark, data, "benchmark")
    whole = {w.items for w in D.blocks(bench)}
    parts = list(D.blocks(bench, most=2_000))
    assert len(parts) > 1 and sorted(i for w in parts for i in w.items) == sorted(*whole)


def test_query_equals_a_plain_search(spark, data, documents):
    bench = {r.item_id: D.fold(r.text.encode()) for r in table(spark, data, "benchmark").collect()}
    docs = {r.doc_id: D.fold(r.text.encode()) for r in documents.collect()}
    whole = {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t}
    rows = op9_decontaminate(spark, data).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert whole <= got and len(rows) == len(got)
    for d, i in got - whole:  # the rest holds a window of the item within its budget
        windows = D.cut_windows([(i, bench[i])])
        assert any(distance(w, docs[d]) <= b for w, b in zip(windows.texts, windows.budgets))


def test_excerpts_are_found_wherever_they_begin():
    item = D.fold(ITEM.encode())
    windows = D.cut_windows([(1, item)])
    for n in (72, 90, 100):
        for start in range(len(item) - n + 1):
            text = b"zz qq " + item[start : start + n] + b" qq zz"
            assert 1 in D.regions(windows, text), (n, start)


def test_replaced_words_within_a_tenth_of_a_short_item_are_found():
    words = D.fold(ITEM.encode()).split()
    for first in range(len(words) - 16):
        item = b" ".join(words[first : first + 16])
        windows = D.cut_windows([(1, item)])
        for i in range(16):
            part = words[first : first + 16]
            part[i] = b"x" * len(part[i])
            text = b"zz qq " + b" ".join(part) + b" qq zz"
            if distance(item, text) <= len(item) // 10:
                assert 1 in D.regions(windows, text), (item, i)


def test_an_item_as_short_as_a_q_gram_is_found():
    windows = D.cut_windows([(1, D.fold(b"Blue Jay"))])
    assert D.regions(windows, D.fold(b"Look, a blue jay!"))[1][2] == 0


def test_items_shorter_than_a_gram_are_found_as_they_stand(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "x forty 2 y"), (2, "x Forty, 2!"), (3, "xforty 2"), (4, "forty 22 forty"), (5, None), (6, "ab ab")],
        "doc_id bigint, text string",
    )
    bench = spark.createDataFrame(
        [(1, "forty 2"), (2, "Ab"), (3, "!?"), (4, "forty-2")], "item_id bigint, text string"
    )
    rows = D.find_passages(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.end, r.windows) for r in rows) == [
        (1, 1, 2, 9, 1), (1, 4, 2, 9, 1), (2, 1, 2, 10, 1), (2, 4, 2, 10, 1), (6, 2, 0, 5, 2),
    ]
    assert sorted(r.doc_id for r in D.clean_documents(docs, bench).collect()) == [3, 4, 5]


def test_several_passes_give_what_one_gives(spark, monkeypatch):
    docs, bench = frames(spark)
    more = spark.createDataFrame([(100 + i, f"{i} other items of this benchmark, number {i}") for i in range(20)], bench.schema)
    bench = bench.unionByName(more)
    one = D.find_passages(docs, bench).collect()
    kept = D.clean_documents(docs, bench).collect()
    monkeypatch.setattr(D, "blocks", lambda *a, most=100: BLOCKS(*a, most=most))
    assert sorted(map(str, D.find_passages(docs, bench).collect())) == sorted(map(str, one))
    assert sorted(map(str, D.clean_documents(docs, bench).collect())) == sorted(map(str, kept))


BLOCKS = D.blocks
