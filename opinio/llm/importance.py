"""Importance resampling towards a target: documents whose n-grams look like the target's.

An n-gram's feature is the crc32 of its bytes. A text is brought to words parted by one
blank and scanned once; the running CRC at the end of every word is kept. CRCs are linear
over GF(2): the CRC of any n-gram is the CRC up to its end, exclusive-or the CRC up to its
begin shifted by the n-gram's length, so n-grams of every length come from the same scan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import stored
from opinio.llm.tokens import runs

# A-Z in lower case, ASCII letters, digits and all other characters kept, the rest blanks.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)
POLYNOMIAL = 0xEDB88320  # fixed value: crc32, least significant bit first
# Bytes of shift that one table covers, and bytes of text scanned together.
SPAN = 64
BYTES_AT_ONCE = 1 << 20
# Buckets are kept in 16 bits, and so many gains travel with the tasks.
MOST_BUCKETS = 1 << 16


@cache
def byte_table() -> np.ndarray:
    """What a byte of the register becomes when it has left it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


def one_byte_on(crc: np.ndarray) -> np.ndarray:
    return byte_table()[crc & 0xFF] ^ (crc >> np.uint32(8))


@cache
def shift_table(level: int) -> np.ndarray:
    """By d and byte place: what a shift by d * SPAN ** level bytes makes of that byte."""
    bytes_at = np.arange(256, dtype=np.uint32)
    table = np.empty((SPAN, 4, 256), np.uint32)
    table[0] = np.stack([bytes_at << np.uint32(8 * k) for k in range(4)])
    for d in range(1, SPAN):
        if level == 0:
            table[d] = one_byte_on(table[d - 1])
        else:  # SPAN - 1 and one more steps of the level below
            below = np.ones(table[d - 1].size, np.int64)
            once = _by_table(table[d - 1].ravel(), below * (SPAN - 1), level - 1)
            table[d] = _by_table(once, below, level - 1).reshape(4, 256)
    return table


def _by_table(crc: np.ndarray, steps: np.ndarray, level: int) -> np.ndarray:
    table = shift_table(level).reshape(-1)
    base = steps * 1024
    return (
        table[base + (crc & 0xFF)]
        ^ table[base + 256 + (crc >> np.uint32(8) & 0xFF)]
        ^ table[base + 512 + (crc >> np.uint32(16) & 0xFF)]
        ^ table[base + 768 + (crc >> np.uint32(24))]
    )


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC moved on by as many bytes: ``crc32(a + b) == shifted(crc32(a), len(b)) ^ crc32(b)``."""
    level, left = 0, lengths.astype(np.int64)
    while left.any():
        crc = _by_table(crc, left % SPAN, level)
        left //= SPAN
        level += 1
    return crc


def feature_crcs(texts: list[bytes], shortest: int = 1, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of all n-grams of all texts, text by text; their number and the words in each text.

    Within a text the n-grams come by size, then place.
    """
    words = [text.translate(FOLD).split() for text in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    # each word with the blank before it; one scan runs through all texts, as the CRC of a
    # part does not depend on what stands before it
    pieces = [b" " + word for some in words for word in some]
    ends = np.fromiter(
        accumulate(pieces, lambda crc, piece: zlib.crc32(piece, crc), initial=0),
        np.uint32,
        len(pieces) + 1,
    )
    begins = ~one_byte_on(~ends[:-1] ^ np.uint32(32))  # past the blank before each word
    places = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))])
    left = np.repeat(np.cumsum(n_words), n_words) - np.arange(len(pieces))  # words to the text's end
    owner = np.repeat(np.arange(len(texts)), n_words)
    crcs, owners = [], []
    for n in range(shortest, longest + 1):
        first = np.flatnonzero(left >= n)
        length = places[first + n] - places[first] - 1
        crcs.append(ends[first + n] ^ shifted(begins[first], length))
        owners.append(owner[first])
    of = np.concatenate(owners)
    order = np.argsort(of, kind="stable") if shortest < longest else slice(None)
    return np.concatenate(crcs)[order], np.bincount(of, minlength=len(texts)), n_words


def featured(
    rows: DataFrame, text: str, buckets: int, shortest: int, longest: int
) -> DataFrame:
    """Columns of ``rows`` but the text, with ``_words`` and ``_buckets`` (16-bit numbers)."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"1 to {MOST_BUCKETS} buckets")
    place = rows.columns.index(text)
    kept = [i for i in range(len(rows.columns)) if i != place]
    schema = rows.drop(text).select(
        "*", F.lit(0).cast("bigint").alias("_words"), F.lit(b"").alias("_buckets")
    ).schema

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for run in runs(batch.column(place).cast(pa.binary()).fill_null(b""), BYTES_AT_ONCE):
                crcs, sizes, words = feature_crcs(run.to_pylist(), shortest, longest)
                numbers = (crcs % np.uint32(buckets)).astype("<u2")
                offsets = np.concatenate([[0], np.cumsum(2 * sizes)]).astype(np.int32)
                found = pa.Array.from_buffers(
                    pa.binary(), len(run), [None, pa.py_buffer(offsets), pa.py_buffer(numbers)]
                )
                others = [batch.column(i).slice(at, len(run)) for i in kept]
                yield pa.RecordBatch.from_arrays(
                    [*others, pa.array(words, pa.int64()), found], names=schema.names
                )
                at += len(run)

    return rows.mapInArrow(per_batch, schema)


def bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, n)`` over ``_buckets``; a task sends at most one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(flat(batch.column(0))[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    partial = rows.select("_buckets").mapInArrow(count, "bucket bigint, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def flat(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a column in one array, and where each row's begin and end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    raw = column.buffers()[2]
    numbers = np.frombuffer(raw, "<u2") if raw else np.empty(0, "<u2")
    return numbers[offsets[0] // 2 : offsets[-1] // 2], (offsets - offsets[0]) // 2


def gains(raw: DataFrame, target: DataFrame, buckets: int, scale: int = 1000) -> np.ndarray:
    """By bucket the floor of ``scale`` times the log odds of target against raw, add-one smoothed.

    ``raw`` and ``target`` are ``(bucket, n)``; what is fetched is bounded by the buckets.
    """
    spark = raw.sparkSession
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    counted = (
        every.join(raw.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
        .toArrow()
    )
    order = np.argsort(counted["bucket"].to_numpy())
    s = counted["s"].to_numpy()[order].astype(np.float64)
    t = counted["t"].to_numpy()[order].astype(np.float64)
    odds = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(scale * np.log(odds)).astype(np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``_buckets`` replaced by ``n_features`` and ``weight``, the floored mean gain (none: 0)."""
    kept = [c for c in rows.columns if c != "_buckets"]
    place = rows.columns.index("_buckets")
    schema = rows.drop("_buckets").select(
        "*", *(F.lit(0).cast("bigint").alias(c) for c in ("n_features", "weight"))
    ).schema

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, edges = flat(batch.column(place))
            sums = np.concatenate([[0], np.cumsum(gain[numbers])])
            sizes = np.diff(edges)
            weight = (sums[edges[1:]] - sums[edges[:-1]]) // np.maximum(sizes, 1)
            others = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(sizes, pa.int64()), pa.array(weight, pa.int64())],
                names=schema.names,
            )

    return rows.mapInArrow(per_batch, schema)


def noise(doc: Column, seed: int) -> Column:
    """A document's Gumbel noise in thousandths, from the hash of ``seed:doc`` (NULL: empty)."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = 10_000,
    shortest: int = 1,
    longest: int = 1,
    fewest_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """``(doc, n_features, weight, score, rank)``, one row for each row of ``docs``.

    ``weight`` is the floored mean of the gains of a document's features (0 if it has none),
    ``score`` adds the document's noise. Of the N rows with ``fewest_words`` words or more the
    ``percent * N / 100`` (floored) of highest score are drawn and numbered from 1 on; others
    have a NULL ``rank``. Ties go to the smaller id, NULL ids last; rows of one id follow
    by their number of features, then weight. NULL texts have no words; repeated rows each
    count; other columns are ignored. Without any target text the gains tell what is rare.
    """
    # own names for all columns: an id may be named as anything made here
    plain = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text"))
    rows = stored(featured(plain, "_text", buckets, shortest, longest), "features")
    wanted = featured(target.select(F.col(target_text).alias("_text")), "_text", buckets, shortest, longest)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets), buckets)
    scored = weighed(rows, gain).withColumn("score", F.col("weight") + noise(F.col("_doc"), seed))
    scored = stored(scored, "scored")

    # scores are whole numbers of some bits: rows are counted by score, and those counts
    # alone are summed in order; a score's rows are numbered apart
    eligible = scored.where(F.col("_words") >= fewest_words)
    by_score = eligible.groupBy("score").agg(F.count("*").alias("_n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    total = by_score.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar()
    bases = (
        by_score.select("score", F.coalesce(F.sum("_n").over(down), F.lit(0)).alias("_base"))
        .withColumn("_drawn", F.floor(total * percent / 100))
        .where(F.col("_base") < F.col("_drawn"))
    )
    within = Window.partitionBy("score").orderBy(
        F.asc_nulls_last("_doc"), "n_features", "weight", "_words"
    )
    reached = eligible.join(bases, "score").withColumn("_place", F.col("_base") + F.row_number().over(within))
    rank = F.when(F.col("_place") <= F.col("_drawn"), F.col("_place"))
    names = [F.col("_doc").alias(doc), "n_features", "weight", "score"]
    drawn = reached.select(*names, rank.cast("bigint").alias("rank"))
    lowest = bases.agg(F.min("score").alias("score")).scalar()
    below = (F.col("_words") < fewest_words) | (F.col("score") < lowest) | lowest.isNull()
    left = scored.where(below).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return drawn.unionByName(left)
