"""Vectors that carry meaning: texts in the space of the corpus' strongest directions.

The matrix of texts by hashed terms, weighted by how rare a bucket is, is never built as a
whole. A randomised range finder multiplies it with a narrow matrix, some passes over the texts,
each a sum of small products made where the texts are; the driver holds matrices of
``buckets`` x ``rank`` alone. Words that occur in the same texts get near vectors, so a text is found
by a question that shares no word with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.counting import counted, text_slices, with_counts
from opinio.session import new_path

BUCKETS, RANK = 2048, 64
# Columns beyond the rank, and passes that sharpen them.
EXTRA, PASSES = 16, 3
SEED = 5
# Rows of counts that are a dense matrix at a time.
ROWS_AT_ONCE = 2048
# Texts whose vectors are made at once.
EMBEDDED_AT_ONCE = 512


@dataclass(frozen=True)
class Basis:
    """Weights of the buckets, the directions (buckets x rank), and how strong each is."""

    idf: np.ndarray
    directions: np.ndarray
    strengths: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of rows of bucket counts; zero for a row without a known bucket."""
        made = weighted(counts, self.idf) @ self.directions
        norms = np.linalg.norm(made, axis=1, keepdims=True)
        return np.divide(made, norms, out=np.zeros_like(made), where=norms > 0)

    def embed(self) -> Callable[[Column], Column]:
        """For ``TextIndex(embed=...)``: a text column to its vectors, a batch at a time."""
        basis = self

        @F.pandas_udf("array<float>")
        def vectors(texts: pd.Series) -> pd.Series:
            column = pa.array(texts.fillna(""), pa.string())
            made = []
            for start, n in text_slices(column, EMBEDDED_AT_ONCE):
                counts = counted(column.slice(start, n), "sparse", len(basis.idf))[2]
                made.append(basis.vectors(_rows_of(counts, len(basis.idf))).astype(np.float32))
            return pd.Series(list(np.concatenate(made)) if made else [])

        return lambda text: vectors(F.lower(F.coalesce(text, F.lit(""))))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: damped counts times the weights of their buckets."""
    made = np.log1p(counts) * idf
    norms = np.linalg.norm(made, axis=1, keepdims=True)
    return np.divide(made, norms, out=np.zeros_like(made), where=norms > 0)


def _rows_of(column: pa.ListArray, buckets: int) -> np.ndarray:
    counts = np.zeros((len(column), buckets))
    entries = column.flatten()
    row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
    counts[row, entries.field("bucket").to_numpy()] = entries.field("n").to_numpy()
    return counts


def _summed(rows: DataFrame, buckets: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` (a matrix of fixed shape) over all rows of bucket counts.

    A task sends one matrix; its rows are added up by number.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = part(_rows_of(batch.column(0).slice(start, ROWS_AT_ONCE), buckets))
                total = made if total is None else total + made
        if total is not None:
            values = [np.ascontiguousarray(line).tobytes() for line in total]
            yield pa.record_batch(
                [pa.array(range(len(total)), pa.int32()), pa.array(values, pa.binary())],
                names=["line", "values"],
            )

    def add(lines: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer()) for v in lines["values"])
        return pa.table({"line": lines["line"][:1].cast(pa.int32()), "values": pa.array([total.tobytes()], pa.binary())})

    partial = rows.select("counts").mapInArrow(per_task, "line int, values binary")
    lines = partial.groupBy("line").applyInArrow(add, "line int, values binary").collect()
    return np.stack([np.frombuffer(r["values"]) for r in sorted(lines, key=lambda r: r["line"])]) if lines else np.zeros((0, 0))


def fit(
    texts: DataFrame, text: str, buckets: int = BUCKETS, rank: int = RANK, passes: int = PASSES
) -> Basis:
    """The ``rank`` strongest directions of all texts. Without a token there are none."""
    path = new_path(texts.sparkSession, "counts")
    found = with_counts(texts.select(text), text, "sparse", buckets)
    found.select(F.col("embedding").alias("counts")).where(F.size("counts") > 0).write.parquet(path)
    rows = texts.sparkSession.read.parquet(path)
    df = _summed(rows, buckets, lambda counts: np.stack([(counts > 0).sum(axis=0), np.full(buckets, len(counts))]).astype(float))
    if not df.size:
        return Basis(np.zeros(buckets), np.zeros((buckets, rank)), np.zeros(rank))
    idf = np.log((1 + df[1, 0]) / (1 + df[0])) + 1
    wide = min(buckets, rank + EXTRA)
    sketch = np.linalg.qr(np.random.default_rng(SEED).normal(size=(buckets, wide)))[0]
    for _ in range(passes):
        product = _summed(rows, buckets, _gram_times(idf, sketch))
        sketch = np.linalg.qr(product)[0]
    small = _summed(rows, buckets, _projected_gram(idf, sketch))
    strength, turned = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-strength)[:rank]
    return Basis(idf, sketch @ turned[:, best], np.sqrt(np.maximum(strength[best], 0)))


def _gram_times(idf: np.ndarray, sketch: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def part(counts: np.ndarray) -> np.ndarray:
        x = weighted(counts, idf)
        return x.T @ (x @ sketch)

    return part


def _projected_gram(idf: np.ndarray, sketch: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def part(counts: np.ndarray) -> np.ndarray:
        y = weighted(counts, idf) @ sketch
        return y.T @ y

    return part
