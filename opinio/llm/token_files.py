"""Token files: Huffman-coded ids in document order, with checkpoints for reading in parts.

The codes come from the counts of all ids. A file row is a document: its ids in blocks of
``BLOCK``, each independent and on a byte boundary, with the bit offset of every
``STRIDE``-th id. ``place`` numbers the documents in order; its upper bits name the file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opinio.llm.common import stored
from opinio.llm.huffman import BLOCK, STRIDE, Decoder, Encoder, code_lengths
from opinio.llm.tokens import runs, word_ids
from opinio.session import new_path, shuffle_partitions

# Ids decoded together by a task.
IDS_AT_ONCE = 1 << 20


# Ids between tokenizer and encoder; a vocabulary beyond it is refused.
NARROW, MOST_IDS = "<u2", 1 << 16


TOTALS = "_totals"


def counted_ids(docs: DataFrame, vocabulary: str, doc: str, text: str, n_ids: int) -> DataFrame:
    """``(doc, ids, _totals)``: ids of each text, and one row per task with the counts of its ids.

    That row has no ids; in the others ``_totals`` is NULL.
    """
    source = docs.select(doc, text)
    schema = f"`{doc}` {source.schema[doc].dataType.simpleString()}, ids binary, `{TOTALS}` binary"
    names = [doc, "ids", TOTALS]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total, kind = word_ids(vocabulary), np.zeros(n_ids, np.int64), None
        for batch in batches:
            at, kind = 0, batch.column(0).type
            for run in runs(batch.column(1).cast(pa.binary()).fill_null(b"")):
                ids, edges = words.encoded(run, NARROW)
                total += np.bincount(ids, minlength=n_ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(run)), binaries(ids, edges), pa.nulls(len(run), pa.binary())],
                    names=names,
                )
                at += len(run)
            pa.system_memory_pool().release_unused()  # back to the machine, for the other workers
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())],
                names=names,
            )

    return source.mapInArrow(encode, schema)


def binaries(values: np.ndarray, edges: np.ndarray) -> pa.BinaryArray:
    """Slices of an array as binary values."""
    offsets = (edges * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def id_counts(tokens: DataFrame) -> DataFrame:
    """``(id, n)`` from the tasks' totals; one row per id and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column(0):
                found = np.frombuffer(value.as_buffer(), np.int64)
                total = found + total if len(total) else found
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    totals = tokens.where(F.col(TOTALS).isNotNull()).select(TOTALS)
    partial = totals.mapInArrow(count, "id bigint, n bigint")
    return partial.groupBy("id").agg(F.sum("n").alias("n"))


def _lengths(counts: DataFrame) -> np.ndarray:
    """Code lengths by id. The rows fetched are bounded by the vocabulary."""
    rows = counts.toArrow()
    by_id = np.zeros(1 + max(rows["id"].to_pylist(), default=0), np.int64)
    by_id[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return code_lengths(by_id)


@cache
def _decoder(lengths: bytes) -> Decoder:
    return Decoder(np.frombuffer(lengths, np.uint8))


@cache
def _encoder(lengths: bytes) -> Encoder:
    return Encoder(np.frombuffer(lengths, np.uint8))


def _encoded(tokens: DataFrame, doc: str, lengths: bytes) -> DataFrame:
    schema = (
        f"`{doc}` {tokens.schema[doc].dataType.simpleString()}, n_tokens bigint, "
        "blocks array<int>, checkpoints binary, payload binary"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(lengths)
        for whole in batches:
            for batch in bounded(whole, pc.binary_length(whole.column("ids")).to_numpy() // 2):
                values = batch.column("ids")
                sizes = pc.binary_length(values).to_numpy().astype(np.int64) // 2
                ids = np.frombuffer(values.buffers()[2] or b"", NARROW)
                first = np.frombuffer(values.buffers()[1], np.int32)[values.offset] // 2
                ids = ids[first : first + sizes.sum()]
                of, counts = divided(sizes, BLOCK)
                payload, begins = encoder.blocks(ids, counts)
                # bit offsets of every STRIDE-th id, from the begin of its block
                bits = np.concatenate([[0], np.cumsum(encoder.lengths[ids])])
                block, runs_of = divided(counts, STRIDE)
                each = np.cumsum(runs_of) - runs_of
                blocks_at = np.cumsum(counts) - counts
                marks = (bits[each] - bits[blocks_at[block]]).astype("<u4")
                in_doc = np.searchsorted(of, np.arange(len(sizes) + 1))
                marks_in_doc = np.searchsorted(of[block], np.arange(len(sizes) + 1))
                yield pa.record_batch(
                    [
                        batch.column(doc),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(in_doc, pa.int32()), pa.array(np.diff(begins), pa.int32())),
                        binaries(marks, marks_in_doc),
                        binaries(np.frombuffer(payload, np.uint8), begins[in_doc]),
                    ],
                    names=[doc, "n_tokens", "blocks", "checkpoints", "payload"],
                )

    return tokens.select(doc, "ids").mapInArrow(encode, schema)


def divided(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``sizes`` things cut into parts of at most ``most``: each part's run, and its size."""
    n = -(-sizes // most)
    of = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    return of, np.minimum(most, sizes[of] - number * most)


def bounded(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most IDS_AT_ONCE ids; a longer document is a slice of its own."""
    within, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        base = within[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(within, base + IDS_AT_ONCE, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def write_token_files(
    docs: DataFrame, vocabulary: str, path: str, doc: str = "doc_id", text: str = "text"
) -> None:
    """Writes ``path/codes`` and ``path/documents`` in ascending ``doc`` order.

    A NULL text counts as empty; a NULL id comes first; rows of equal id stay, next to each
    other. Columns other than the two are not written.
    """
    spark = docs.sparkSession
    n_ids = 1 + max(Tokenizer.from_file(vocabulary).get_vocab().values())
    if n_ids > MOST_IDS:
        raise ValueError(f"more than {MOST_IDS} ids")
    tokens = stored(counted_ids(docs, vocabulary, doc, text, n_ids), "tokens")
    lengths = _lengths(id_counts(tokens)).tobytes()
    spark.createDataFrame([(bytearray(lengths),)], "lengths binary").coalesce(1).write.parquet(
        f"{path}/codes"
    )
    # the row number tells equal ids apart, so that many tasks may share them
    ordered = (
        tokens.where(F.col("ids").isNotNull())
        .select(doc, "ids")
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(spark), doc, "row")
        .sortWithinPartitions(doc, "row")
        .drop("row")
    )
    (
        _encoded(ordered, doc, lengths)
        .withColumn("place", F.monotonically_increasing_id())
        .write.option("compression", "uncompressed")
        .parquet(f"{path}/documents")
    )


def read_token_files(spark: SparkSession, path: str, doc: str = "doc_id") -> DataFrame:
    """``(doc, place, n_tokens, ids)`` of every document in the files."""
    lengths = bytes(spark.read.parquet(f"{path}/codes").first()["lengths"])
    rows = spark.read.parquet(f"{path}/documents")
    rows = rows.select(doc, "place", "n_tokens", "blocks", "checkpoints", "payload")
    schema = (
        f"`{doc}` {rows.schema[doc].dataType.simpleString()}, place bigint, n_tokens bigint, "
        "ids binary"
    )

    def some(decoder: Decoder, part: pa.RecordBatch) -> pa.BinaryArray:
        """The ids of some documents, all their runs of ids decoded together."""
        sizes = part.column("n_tokens").to_numpy().astype(np.int64)
        payload = b"".join(part.column("payload").to_pylist())
        marks = np.frombuffer(b"".join(part.column("checkpoints").to_pylist()), "<u4").astype(np.int64)
        block_bytes = part.column("blocks").flatten().to_numpy().astype(np.int64)
        _, counts = divided(sizes, BLOCK)
        block, runs_of = divided(counts, STRIDE)
        begins = np.cumsum(block_bytes) - block_bytes
        ids = decoder.lanes(payload, marks + 8 * begins[block], runs_of)
        return binaries(ids.astype("<u4"), np.concatenate([[0], np.cumsum(sizes)]))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(lengths)
        for batch in batches:
            for part in bounded(batch, batch.column("n_tokens").to_numpy()):
                yield pa.record_batch(
                    [*(part.column(c) for c in part.schema.names[:3]), some(decoder, part)],
                    names=[doc, "place", "n_tokens", "ids"],
                )

    return rows.mapInArrow(decode, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before a row's ``place``.

    Sums run within a file; the files' totals, one row each, are summed first. ``rows`` are
    read twice, so they should be stored or cheap.
    """
    filed = rows.withColumn("_file", F.shiftright("place", 33))
    totals = filed.groupBy("_file").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = (
        Window.partitionBy("_file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        filed.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(bases, "_file")
        .withColumn("start", F.col("_base") + F.col("_inside"))
        .drop("_file", "_base", "_inside")
    )


def token_file_round_trip(
    docs: DataFrame, vocabulary: str, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes the files to the shared folder and reads ``(doc, place, n_tokens, ids)`` back."""
    path = new_path(docs.sparkSession, "token_files")
    write_token_files(docs, vocabulary, path, doc, text)
    return read_token_files(docs.sparkSession, path, doc)
