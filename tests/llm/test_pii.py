from __future__ import annotations

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from opinio.llm import pii
from opinio.llm.queries import op8_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (2 if place % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text: str | None) -> list[tuple[int, int, str]]:
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and passes_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(found)


TEXTS = [
    None,
    "",
    "mail a@b.c_d@e.f and x@y then z..@q.r-.s",
    "ipé 1.2.3.4 001.02.255.0256 256.1.1.1 1.2.3.4.5.6.7.8 9.9.9",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 5500 0000 0000 0004x",
    "call +49 (30) 123-4567 or +1.2 or +12345678901234567",
    "😀 a.b@c.de 😀😀 +1 (017) 555-7713",
    "1" * 50_000 + " " + "a" * 50_000 + "@" + "b" * 3,
    ("a@b.cd " * 300) + "1.1.1.1",
    "iban DE89 3704 0044 0532 0130 00 and DE89370400440532013001",
    'token = "04dbebab91ab8568" ssn 123-45-6789 or 123-45-6789',
]


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii.find_spans(docs).select("doc_id", "pii", pii.spelled(F.col("pii")).alias("s"))
    return {r.doc_id: r for r in rows.collect()}


def test_base_spans_equal_a_plain_search(spark):
    for number, row in run(spark, TEXTS).items():
        base = [s for s in row.pii if s.kind in PATTERNS]
        assert [f"{s.kind}:{s.start}:{s.end}" for s in base] == [
            b[2] for b in brute(TEXTS[number])
        ], number


def test_checksums_and_context(spark):
    rows = run(spark, TEXTS)
    assert [s.kind for s in rows[9].pii if s.kind == "iban"] == ["iban"]
    assert [s.kind for s in rows[10].pii] == ["secret", "ssn", "ssn"]
    alone = run(spark, ["the number 123-45-6789 is here", "ssn 123-45-6789"])
    assert not alone[0].pii and alone[1].pii[0].score == 0.7


def test_query_over_the_table(spark, data, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op8_pii(spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        spans = [b[2] for b in brute(texts[row.doc_id])]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert row.n_email == sum(s.startswith("email") for s in spans)
        assert set(spans) <= set(row.spans.split(",")) | {""}


def test_masking_keeps_rows_columns_and_the_rest_of_the_text(spark):
    docs = spark.createDataFrame(
        [
            (1, "to x@y.zz, +1 (017) 555-7713!", "en", 29, "a", 1, "m"),
            (1, "to x@y.zz, +1 (017) 555-7713!", "en", 29, "a", 1, "m"),
            (2, None, None, None, None, None, None),
            (None, "clean", "en", 7, "b", 2, "n"),
        ],
        "doc_id bigint, text string, lang string, n_chars bigint, _pii string, spans int, _masked string",
    )
    rows = [tuple(r) for r in pii.mask_documents(docs).collect()]
    assert rows[0] == rows[1] == (1, "to [EMAIL], [PHONE]!", "en", 20, "a", 1, "m")
    assert rows[2] == (2, *[None] * 6) and rows[3] == (None, "clean", "en", 7, "b", 2, "n")
    assert pii.mask_documents(docs.limit(0)).count() == 0


def test_a_long_secret_is_masked_to_its_end(spark):
    text = "api_key=" + "aB3" * 333 + "x and more"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    (row,) = pii.find_spans(docs, out="pii").collect()
    (secret,) = [s for s in row.pii if s.kind == "secret"]
    assert text[secret.start : secret.end] == text.removesuffix(" and more")
    (masked,) = pii.mask_documents(docs, length=None).collect()
    assert "aB3" not in masked.text and masked.text.endswith(" and more")


def brute_mask(text, spans):
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["4111 1111 1111 1111", "1.2.3.4", "a@b.cd", "+49 30 1234567", "123-45-6789", "ssn ", "12 ", "1", "-", " ",
             "x", "\U0001F600", "\n", "token=abcdefgh12", "DE89370400440532013000", ".", "@", "+1", "5500-0000-0000-0004"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_random_texts_spans_and_masks(spark, monkeypatch):
    monkeypatch.setattr(pii, "BLOCK", 5)
    texts = random_texts(800, 6)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii.find_spans(docs).withColumn("m", pii.masked(F.col("text"), F.col("pii"))).collect()
    for r in rows:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in r.pii if s.kind in PATTERNS]
        assert base == [b[2] for b in brute(r.text)], r.text
        assert r.m == brute_mask(r.text, r.pii), r.text


def test_twice_the_text_takes_about_twice_the_time(spark):
    def seconds(n, unit):
        docs = spark.createDataFrame([(1, unit * n)], "doc_id bigint, text string")
        begun = time.time()
        (row,) = pii.mask_documents(docs, length=None).select(F.length("text").alias("n")).collect()
        return time.time() - begun, row.n

    for unit in ("x 12 ", "a@b.cd ", "4111 1111 1111 1111; "):
        seconds(10, unit)
        n = 1_000_000 // len(unit)
        half, _ = seconds(n // 2, unit)
        whole, _ = seconds(n, unit)
        assert whole < 40 and whole < 3.2 * half + 2, unit
