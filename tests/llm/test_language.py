from __future__ import annotations

import zlib

from opinio.llm import language
from opinio.llm.queries import op1_language_id

ROWS = [
    (1, "the cat and the dog and the bird were in the garden of the house", "en", "x", None),
    (2, "der Hund und die Katze und der Vogel sind in dem Garten von dem Haus", "de", "y", None),
    (2, "der Hund und die Katze und der Vogel sind in dem Garten von dem Haus", "de", "y", None),
    (None, "the dog sleeps in the house and the cat in the garden", None, None, 1.0),
    (4, None, "en", None, None),
    (5, "", "de", None, None),
    (6, "12345 !!! ...", "en", None, None),
    (7, "und die Katze und der Vogel " * 3000, None, None, 0.0),
    (8, "日本語", None, None, 0.0),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, lang_pred string, score double"
    )


def test_odd_rows_have_defined_results(spark):
    languages = language.fit(frame(spark))
    assert languages.names == ("de", "en")
    rows = [tuple(r) for r in language.predict(frame(spark), languages).collect()]
    assert [r[1] for r in rows] == ["en", "de", "de", "en", "und", "und", "und", "de", rows[8][1]]
    assert rows[8][1] in languages.names and all(0 <= r[2] <= 1 for r in rows)
    assert rows[1] == rows[2] and rows[4][3]


def test_repeats_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PIECES", 3)
    rows = [(i, "again and again", "en", None, None) for i in range(50)] + ROWS
    sample = language.fit(frame(spark, rows))
    assert sample.samples[sample.names.index("en")].count(b"again and again") <= 1
    assert sample.samples[sample.names.index("en")].count(b"the cat") <= 1


def test_all_of_a_text_can_be_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PIECES", 40)
    rows = [(1, "".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)} " * 256 for i in range(20)), "en", None, None)]
    rows += [(2 + i, f"word{chr(97 + i)} " * 300, "hot", None, None) for i in range(26)] * 40
    learned = language.fit(frame(spark, rows).repartition(6))
    english = learned.samples[learned.names.index("en")]
    assert all(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}".encode() in english for i in range(20))
    one = language.fit(frame(spark, rows).coalesce(1))
    assert learned == one  # whatever the tasks


def test_sizes_equal_plain_compression(spark):
    import zstandard

    learned = language.fit(frame(spark))
    for text in (r[1] for r in ROWS if r[1]):
        want = []
        for sample in learned.samples:
            total, body = 0, b" " + language.letters(text.encode()) + b" "
            for at in range(0, len(body), language.BLOCK):
                settings = zstandard.ZstdCompressionParameters.from_level(
                    language.LEVEL, min_match=language.SHORTEST_MATCH,
                    write_content_size=False, write_checksum=False, write_dict_id=False,
                )
                kind = zstandard.DICT_TYPE_RAWCONTENT
                packer = zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(sample, dict_type=kind), compression_params=settings
                )
                total += len(packer.compress(body[at : at + language.BLOCK]))
            want.append(total)
        got = language.sizes(learned, text.encode())
        # a prepared dictionary may be searched a little differently
        assert all(abs(a - b) <= 8 + b // 20 for a, b in zip(got, want)), (got, want)


def test_nothing_learned_and_no_rows(spark):
    none = language.fit(frame(spark).limit(0))
    assert none == language.Languages((), ())
    assert {r.lang_pred for r in language.predict(frame(spark), none).collect()} == {"und"}
    assert language.predict(frame(spark).limit(0), none).count() == 0


def test_query_on_held_out_rows(spark, data, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = op1_language_id(spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.95
