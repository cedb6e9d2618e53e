from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from opinio.llm import packing, token_files
from opinio.llm import tokens as tk
from opinio.llm.differencing import partition, windows
from opinio.llm.huffman import BLOCK, STRIDE, Decoder, Encoder, code_lengths
from opinio.llm.queries import op5_packing, op7_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "it's I'M DON'T x'Re",
    "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b",
    "İstanbul Ⅷ ǅ J̌ é ́x",
    "\x00\x01a \x1cb\x1d c d e\u0085f",
    "日本語 テスト ①②",
    "a\tb\x0bc\x0cd ſ K Å ﬁ ŉ",
    "Σας ΣΑΣ ... !!! '' 'sa 's' ÀÉÜß",
    "",
    "x" * 3000,
    "a.b é.x é…. à×. a÷! thing*** (it's) !'s x,'s 'S. don't!! ÿ? ſ; a·b ß—c, 5.é)",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def expected(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [tk.END_ID]


def test_words_give_the_ids_of_the_whole_text(whole, documents, monkeypatch):
    monkeypatch.setattr(tk, "WORDS_KEPT", 500)
    texts = ODD + [r.text for r in documents.collect()]
    words = tk.WordIds(PATH)
    for run in tk.runs(pa.array([t.encode() for t in texts], pa.binary()), 20_000):
        for text, ids in zip(run, words.texts(run)):
            assert np.frombuffer(ids, "<u4").tolist() == expected(whole, text.as_py().decode())


def test_random_texts_give_the_ids_of_the_whole_text(whole):
    rng = np.random.default_rng(11)
    signs = [*"aZe \t\n!'.,-(09<|>", "\u0130", "\u0131", "\u0307", "\u00e9", "\u00c9", "\u00d7", "\u0133", "ff", "\u017f", "\u00df", "\u0149", "'s", "'LL", "\u6c34"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(20_000)]
    texts += ["MEMLEKET\u0130!", "\u0130.\u0130", "i\u0130-a\u0130's"]
    words = tk.WordIds(PATH)
    found = words.texts(pa.array([t.encode() for t in texts], pa.binary()), "<u2")
    wanted = whole.encode_batch(texts, add_special_tokens=False)
    for text, ids, want in zip(texts, found, wanted):
        assert np.frombuffer(ids, "<u2").tolist() == [*want.ids, tk.END_ID], text


def best_total(counts, max_bits):
    """Cost of the best limited code, from the plain definition of package-merge."""
    n = len(counts)
    last = []
    for _ in range(max_bits):
        pairs = [last[i][0] + last[i + 1][0] for i in range(0, len(last) - 1, 2)]
        last = sorted([(c,) for c in counts] + [(p,) for p in pairs])
    return sum(x[0] for x in last[: 2 * n - 2])


@pytest.mark.parametrize("max_bits", [4, 6, 18])
def test_code_lengths_are_limited_and_best(max_bits):
    rng = np.random.default_rng(max_bits)
    counts = (2 ** rng.integers(0, 12, 14)).astype(np.int64)
    counts[3] = 0
    lengths = code_lengths(counts, max_bits)
    assert lengths[3] == 0 and lengths.max() <= max_bits
    assert sum(2.0 ** -int(n) for n in lengths if n) == 1
    assert int((lengths * counts).sum()) == best_total([c for c in counts if c], max_bits)
    with pytest.raises(ValueError):
        code_lengths(np.ones(40, np.int64), 5)


@pytest.mark.parametrize("n", [0, 1, STRIDE, STRIDE + 1, BLOCK - 1, BLOCK])
def test_blocks_decode_from_every_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 4000).astype(np.uint32)
    lengths = code_lengths(np.bincount(ids, minlength=4001) + 1)
    payload, marks = Encoder(lengths).block(ids)
    counts = np.array([min(STRIDE, n - i * STRIDE) for i in range(len(marks))], np.int64)
    decoder = Decoder(lengths)
    assert np.array_equal(decoder.lanes(payload, marks.astype(np.int64), counts), ids)
    for i in range(len(marks)):
        one = decoder.lanes(payload, marks[i : i + 1].astype(np.int64), counts[i : i + 1])
        assert np.array_equal(one, ids[i * STRIDE : (i + 1) * STRIDE])


def odd_docs(spark):
    rows = [(i, t, "a", "b") for i, t in enumerate(ODD)]
    rows += [(None, None, "a", None), (None, "null id", None, "b"), (2, ODD[2], "a", "b")]
    rows += [(50, "word " * 70_000, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, row string")


def test_token_files_of_odd_rows(spark, whole):
    docs = odd_docs(spark)
    read = token_files.token_file_round_trip(docs, PATH)
    rows = token_files.with_starts(read).orderBy("place").collect()
    want = sorted(
        (((r.doc_id is not None, r.doc_id or 0), expected(whole, r.text)) for r in docs.collect()),
    )
    assert sorted(
        ((r.doc_id is not None, r.doc_id or 0), np.frombuffer(r.ids, "<u4").tolist()) for r in rows
    ) == want
    assert [k for k, _ in want] == [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens


def test_token_files_of_no_rows(spark):
    docs = odd_docs(spark).limit(0)
    assert token_files.with_starts(token_files.token_file_round_trip(docs, PATH)).count() == 0
    assert packing.pack(docs, PATH).count() == 0


def test_token_file_query(spark, data, documents, whole):
    rows = {r.doc_id: r for r in op7_token_files(spark, data).collect()}
    at = 0
    for r in documents.orderBy("doc_id").collect():
        ids = expected(whole, r.text)
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        got = rows.pop(r.doc_id)
        assert (got.start, got.n_tokens, got.ids_crc32) == (at, len(ids), crc)
        at += len(ids)
    assert not rows


def test_differencing_places_every_item_once():
    rng = np.random.default_rng(5)
    for ways in (1, 2, 3, 10):
        sizes = rng.integers(1, 100, 40).tolist()
        parts = partition(sizes, ways)
        assert len(parts) == ways and sorted(i for p in parts for i in p) == list(range(40))
        sums = [sum(sizes[i] for i in p) for p in parts]
        assert max(sums) - min(sums) <= 8
    assert partition([], 3) == [[], [], []]


def test_more_windows_where_one_overflows():
    assert len(windows([60, 60, 60], 100)) == 3
    assert len(windows([50] * 4, 100)) == 2
    assert windows([], 100) == []


def check_packing(rows, lengths):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_doc.values():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == total
    assert {d: p[0][2] for d, p in by_doc.items()} == lengths
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return sum(lengths.values()) / (packing.CAPACITY * len(by_sequence))


def test_packing_query(spark, data, documents, whole):
    texts = {r.doc_id: expected(whole, r.text) for r in documents.collect()}
    rows = op5_packing(spark, data).collect()
    assert check_packing(rows, {d: len(ids) for d, ids in texts.items()}) > 0.97
    for r in rows:
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_odd_rows(spark, whole):
    docs = odd_docs(spark).where("doc_id is not null and doc_id != 2")
    rows = packing.pack(docs, PATH, group_bytes=2_000).collect()
    check_packing(rows, {r.doc_id: len(expected(whole, r.text)) for r in docs.collect()})
    every = packing.pack(odd_docs(spark), PATH).collect()
    assert sum(r.length for r in every) == sum(
        len(expected(whole, r.text)) for r in odd_docs(spark).collect()
    )
