"""Packing of token ids into training windows by multiway differencing.

A document's ids are cut into whole windows and, from what is left, pieces short enough
that many share a window. The pieces of a bounded share of the documents meet in one
group, where differencing deals them into near-equal windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.differencing import windows
from opinio.llm.tokens import runs, word_ids

CAPACITY = 4096
# Longest piece of what a document leaves beyond whole windows.
PIECE = 512
# Bytes of text whose pieces form a group: some 100 to 250 windows. A word byte gives
# at most one id, so a group stays below its bytes in ids, plus the end ids.
GROUP_BYTES = 1_500_000
# Sequence ids are group * GROUP_IDS + number in the group.
GROUP_IDS = 1 << 24


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids, in order."""
    whole = n - n % capacity
    found = [(start, capacity) for start in range(0, whole, capacity)]
    return found + [(start, min(piece, n - start)) for start in range(whole, n, piece)]


def pieces(
    docs: DataFrame, vocabulary: str, doc: str, text: str, capacity: int, piece: int
) -> DataFrame:
    """``(doc, row, start, length, doc_tokens, ids)`` of every document row.

    Texts become ids and pieces in one pass, so a task needs one Python worker.
    """
    source = docs.select(doc, text, F.monotonically_increasing_id().alias("row"))
    kind = source.schema[doc].dataType.simpleString()
    schema = f"`{doc}` {kind}, row bigint, start bigint, length bigint, doc_tokens bigint, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        for batch in batches:
            first = 0
            for run in runs(batch.column(1).cast(pa.binary()).fill_null(b"")):
                found = words.texts(run)
                sizes = np.array([len(ids) // 4 for ids in found], np.int64)
                source, starts, lengths, ids = [], [], [], []
                for i, whole in enumerate(found):
                    for start, length in cuts(len(whole) // 4, capacity, piece):
                        source.append(i)
                        starts.append(start)
                        lengths.append(length)
                        ids.append(whole[4 * start : 4 * (start + length)])
                at = np.array(source, np.int64)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(at + first)),
                        batch.column(2).take(pa.array(at + first)),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sizes[at]),
                        pa.array(ids, pa.binary()),
                    ],
                    names=[doc, "row", "start", "length", "doc_tokens", "ids"],
                )
                first += len(run)
            pa.system_memory_pool().release_unused()  # back to the machine, for the other workers

    return source.mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    vocabulary: str,
    doc: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``(doc, start, length, ids, doc_tokens, sequence_id, offset)``, one row per piece.

    ``ids`` are little-endian unsigned 32-bit integers; a document's end with the end id.
    A sequence holds at most ``capacity`` ids without gaps. A NULL or empty text is a
    document of the end id alone. Repeated rows and rows without an id are packed each on
    its own. No documents give no rows. Columns of ``docs`` other than the two are ignored.
    """
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0] or 0
    n_groups = max(1, -(-size // group_bytes))
    group = F.pmod(F.xxhash64("row", "start"), F.lit(n_groups))
    cut = pieces(docs, vocabulary, doc, text, capacity, piece).withColumn("group", group)
    kind = cut.schema[doc].dataType.simpleString()
    schema = (
        f"`{doc}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )

    def place(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lengths = rows["length"].to_pylist()
        short = [i for i, n in enumerate(lengths) if n < capacity]
        filled = [[i] for i, n in enumerate(lengths) if n == capacity]
        # a fixed order of the pieces, whatever order the shuffle delivered
        named = list(zip(rows["row"].to_pylist(), rows["start"].to_pylist()))
        short.sort(key=lambda i: (-lengths[i], named[i]))
        filled.sort(key=lambda parts: named[parts[0]])
        if short:
            filled += [
                [short[i] for i in part] for part in windows([lengths[i] for i in short], capacity)
            ]
        take = [i for part in filled for i in part]
        first = key[0].as_py() * GROUP_IDS
        sequence = [first + n for n, part in enumerate(filled) for _ in part]
        offsets = []
        for part in filled:
            offset = 0
            for i in part:
                offsets.append(offset)
                offset += lengths[i]
        placed = rows.select([doc, "start", "length", "ids", "doc_tokens"]).take(pa.array(take))
        return placed.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column(
            "offset", pa.array(offsets, pa.int64())
        )

    return cut.groupBy("group").applyInArrow(place, schema)
