"""Language of a text by compression: the dictionary that shortens it most names it.

Each language has a raw-content dictionary of sample text. A text is compressed block by
block against every dictionary, so a long text cannot learn from itself what the
dictionary should tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
# Bounded sample: pieces of labelled texts in a language's dictionary, and bytes of a piece.
# All pieces of whole texts compete for a place.
SAMPLE_PIECES = 96
PIECE = 1024
# More labels than this are refused: each has a dictionary that travels with the tasks.
MOST_LANGUAGES = 1000
# Tasks' pieces are first ranked in so many shares of a language, so that no task gets them all.
SHARES = 64
# Bytes compressed at a time, the level of compression and its shortest match.
BLOCK = 8192
LEVEL = 5
SHORTEST_MATCH = 4
# Letters tell a language: A-Z in lower case, other ASCII as blanks, runs of blanks as one.
FOLD = bytes(
    c | 32 if chr(c).isupper() and c < 128 else c if c >= 128 or chr(c).isalpha() else 32
    for c in range(256)
)
# Relative gap between the best two sizes below which the answer is rejected.
MARGIN = 0.02


@dataclass(frozen=True)
class Languages:
    """Learned dictionaries, the most frequent language first; small enough to travel with tasks."""

    names: tuple[str, ...]
    samples: tuple[bytes, ...]


def lowest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of lowest hash that a task has met, by language, from (lang, text)."""
    kept: dict[str, dict[int, bytes]] = {}
    bounds: dict[str, int] = {}
    for batch in batches:
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole = letters(value.as_buffer().to_pybytes())
            some = kept.setdefault(lang, {})
            for at in range(0, len(whole), PIECE):
                piece = whole[at : at + PIECE]
                digest = xxhash.xxh64_intdigest(piece) - (1 << 63)
                if digest <= bounds.get(lang, 1 << 63):
                    some[digest] = piece
            if len(some) > 4 * SAMPLE_PIECES:
                kept[lang] = {h: some[h] for h in sorted(some)[:SAMPLE_PIECES]}
                bounds[lang] = max(kept[lang])
    for lang, some in kept.items():
        hashes = sorted(some)[:SAMPLE_PIECES]
        yield pa.record_batch(
            [
                pa.array([lang] * len(hashes), pa.string()),
                pa.array(hashes, pa.int64()),
                pa.array([some[h] for h in hashes], pa.binary()),
            ],
            names=["lang", "hash", "sample"],
        )


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Languages:
    """Dictionaries from rows with a language and a text; the most frequent language first.

    Texts are cut whole into pieces; of every language the SAMPLE_PIECES pieces are used
    whose hashes are lowest, wherever they stand, so repeated rows count once and no row
    order matters. A task keeps its lowest, so what is shuffled and fetched does not grow
    with the texts. NULL and empty texts are left out.
    """
    pool = labelled.where(F.col(lang).isNotNull() & (F.col(lang) != UNKNOWN)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    pool = pool.where(F.octet_length("text") > 0)
    found = pool.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = {r["lang"]: r["count"] for r in found}

    def lowest(*by: str) -> Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy("hash"))

    share = F.pmod(F.xxhash64("hash"), F.lit(SHARES))
    samples = (
        pool.mapInArrow(lowest_pieces, "lang string, hash bigint, sample binary")
        .groupBy("lang", "hash")
        .agg(F.min("sample").alias("sample"))
        .withColumn("share", share)
        .withColumn("n", lowest("lang", "share"))
        .where(F.col("n") <= SAMPLE_PIECES)
        .withColumn("n", lowest("lang"))
        .where(F.col("n") <= SAMPLE_PIECES)
        .collect()
    )
    names = sorted(counts, key=lambda name: (-counts[name], name))
    parts = {name: [] for name in names}
    for row in sorted(samples, key=lambda r: (r.lang, r.hash)):
        parts[row.lang].append(bytes(row.sample))
    return Languages(tuple(names), tuple(b" ".join(parts[name]) for name in names))


@cache
def _compressors(languages: Languages) -> list[zstandard.ZstdCompressor]:
    made = []
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        min_match=SHORTEST_MATCH,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    for sample in languages.samples:
        dictionary = zstandard.ZstdCompressionDict(
            sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        dictionary.precompute_compress(compression_params=settings)
        made.append(
            zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)
        )
    return made


def letters(text: bytes) -> bytes:
    return b" ".join(text.translate(FOLD).split())


def sizes(languages: Languages, text: bytes) -> list[int]:
    """Compressed size of the whole text under every language."""
    text = b" " + letters(text) + b" "
    blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    return [sum(len(c.compress(b)) for b in blocks) for c in _compressors(languages)]


def judge(languages: Languages, text: str | None) -> tuple[str, float, bool]:
    """(language, score, rejected). Equal sizes go to the more frequent language.

    The score is the relative gap to the second best size, 1 with a single language.
    """
    if not text or not languages.names or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    found = sizes(languages, text.encode())
    best = min(range(len(found)), key=lambda i: (found[i], i))
    others = found[:best] + found[best + 1 :]
    gap = (min(others) - found[best]) / min(others) if others else 1.0
    return languages.names[best], gap, gap < MARGIN


def predict(
    docs: DataFrame, languages: Languages, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc, lang_pred, score, lang_rejected)``, one row for each row of ``docs``.

    ``lang_pred`` is the closest learned language, whatever the margin, or ``und`` where
    the text is NULL or has no letter (or nothing was learned), with score 0.
    ``lang_rejected`` is true for those and for margins below MARGIN. Repeated rows are
    each judged; other columns are ignored.
    """
    source = docs.select(doc, text)
    schema = (
        f"`{doc}` {source.schema[doc].dataType.simpleString()}, lang_pred string, "
        "score double, lang_rejected boolean"
    )

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(languages, value.as_py()) for value in batch.column(1)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_()),
                ],
                names=[doc, "lang_pred", "score", "lang_rejected"],
            )

    return source.mapInArrow(per_batch, schema)

