import pyarrow as pa

from opinio.functions import counting


def test_texts_are_counted_by_bytes_and_number(monkeypatch):
    texts = pa.array(["a" * 400, "b" * 400, "c" * 5000, "", "d"])
    monkeypatch.setattr(counting, "BYTES_AT_ONCE", 1000)
    assert [*counting.text_slices(texts)] == [(0, 2), (2, 1), (3, 2)]
    assert [*counting.text_slices(texts, 1)] == [(i, 1) for i in range(5)]
    assert [*counting.text_slices(pa.array([], pa.string()))] == []
