"""Approximate nearest vectors from an inverted file: trained cells on disk, sign codes in them.

Centres are fitted on a bounded sample. Every vector is stored in the folder of its nearest
centre, with a code of the signs of its projections on fixed random directions. A query
reads the cells nearest to it, and of their vectors scores those whose code is close to its own;
the others are never multiplied. Which vectors that are depends on the fitted centres and on
the vectors alone, not on how the table is split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from opinio.operators.topk import (
    Hits,
    MakeScorer,
    Prepare,
    Score,
    by_query_blocks,
    exact_topk,
    highest,
    pair_scores,
    round_half_up,
    unit_rows,
)
from opinio.session import new_path, path_exists, shuffle_partitions

# Fitted on at most so many vectors, those whose ids hash lowest.
SAMPLE = 20_000
ROUNDS = 12
# About one cell for the square root of the vectors, at most so many.
MOST_CELLS = 4096
# Bits of a code, and the seed of its directions.
CODE_BITS, SEED = 256, 7
# A query's cells hold about this share of all vectors, and it scores those of them whose code
# is among the closest share of all.
REACH, SCORED = 0.65, 0.2
DIGITS = 6
# Queries whose cells are chosen at once, and vectors compared with all centres at once.
PLANNED_AT_ONCE, PLACED_AT_ONCE = 64, 512


@dataclass(frozen=True)
class Fit:
    """What a search needs besides the stored cells; bounded by the sample."""

    centres: np.ndarray
    sizes: np.ndarray  # of the cells among the sample
    codes: np.ndarray  # of the sample

    @cached_property
    def directions(self) -> np.ndarray:
        return np.random.default_rng(SEED).normal(size=(self.centres.shape[1], CODE_BITS))

    def code(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits(unit @ self.directions > 0, axis=1)

    def cell(self, unit: np.ndarray) -> np.ndarray:
        parts = [
            (unit[start : start + PLACED_AT_ONCE] @ self.centres.T).argmax(axis=1)
            for start in range(0, len(unit), PLACED_AT_ONCE)
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def plan(self, unit: np.ndarray, reach: float, scored: float | None) -> tuple[np.ndarray, np.ndarray]:
        """By query: which cells it reads, and how many bits of a scored code may differ (None: not asked for)."""
        wanted = np.zeros((len(unit), len(self.sizes)), bool)
        most = np.zeros(len(unit), np.int64)
        # some queries at a time: each is compared with every centre and the whole sample
        for start in range(0, len(unit), PLANNED_AT_ONCE):
            some = slice(start, start + PLANNED_AT_ONCE)
            order = np.argsort(-(unit[some] @ self.centres.T), axis=1, kind="stable")
            before = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]
            # the nearest cells until they hold the share, the one that reaches it included
            np.put_along_axis(wanted[some], order, before < reach * self.sizes.sum(), axis=1)
            if scored is not None and len(self.codes):
                far = distances(self.code(unit[some]), self.codes)
                most[some] = np.quantile(far, scored, axis=1, method="higher")
        return wanted, most


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which each code of ``a`` differs from each of ``b``."""
    x, y = (np.ascontiguousarray(c).view(np.uint64) for c in (a, b))
    total = np.zeros((len(x), len(y)), np.uint16)
    for word in range(x.shape[1]):
        total += np.bitwise_count(x[:, word, None] ^ y[None, :, word])
    return total


def fitted(unit: np.ndarray, n_cells: int, rounds: int = ROUNDS) -> Fit:
    """Spherical k-means on unit vectors; deterministic. An empty cell keeps its centre."""
    n_cells = max(1, min(n_cells, len(unit)))
    rng = np.random.default_rng(SEED)
    if not len(unit):
        width = unit.shape[1] if unit.ndim == 2 else 0
        return Fit(np.zeros((1, width)), np.zeros(1, np.int64), np.zeros((0, CODE_BITS // 8), np.uint8))
    centres = unit[rng.choice(len(unit), n_cells, replace=False)]
    for _ in range(rounds):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        norms = np.linalg.norm(sums, axis=1)
        moved = norms > 0
        centres = np.where(moved[:, None], sums / np.where(moved, norms, 1)[:, None], centres)
    made = Fit(centres, np.bincount((unit @ centres.T).argmax(axis=1), minlength=n_cells), np.zeros((0, CODE_BITS // 8), np.uint8))
    return Fit(made.centres, made.sizes, made.code(unit))


@dataclass(frozen=True)
class VectorCells:
    """Vectors ``(id, embedding)`` in cells under one path; ids are unique."""

    spark: SparkSession
    path: str

    @property
    def built(self) -> bool:
        return path_exists(self.spark, f"{self.path}/fit")

    def build(self, vectors: DataFrame, n_cells: int | None = None, sample: int = SAMPLE) -> VectorCells:
        """Fits the centres and stores the vectors that are not zero, once."""
        usable = vectors.select("id", "embedding").where(F.col("embedding").isNotNull())
        # zero vectors are not stored: they hit nothing
        usable = usable.where(F.exists("embedding", lambda x: x != 0))
        n = usable.count()
        some = usable.select("embedding", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(sample)
        unit, _ = unit_rows(some.select("embedding").toArrow())
        fit = fitted(unit, n_cells or min(MOST_CELLS, max(1, round(n**0.5))))
        self._write(usable, fit)
        row = [tuple(bytearray(np.ascontiguousarray(x).tobytes()) for x in (fit.centres, fit.sizes, fit.codes))]
        made = self.spark.createDataFrame(row, "centres binary, sizes binary, codes binary")
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/fit")
        return self

    @property
    def fit(self) -> Fit:
        row = self.spark.read.parquet(f"{self.path}/fit").first()
        sizes = np.frombuffer(row["sizes"], np.int64)
        codes = np.frombuffer(row["codes"], np.uint8).reshape(-1, CODE_BITS // 8)
        return Fit(np.frombuffer(row["centres"]).reshape(len(sizes), -1), sizes, codes)

    def rows(self) -> DataFrame:
        """``(id, embedding, code, cell)``."""
        return self.spark.read.parquet(f"{self.path}/cells")

    def upsert(self, vectors: DataFrame, gone: DataFrame) -> None:
        """Vectors replaced or added, and ids taken out; only the cells they touch are rewritten.

        To find the cells of known ids, ids alone are read.
        """
        fit = self.fit
        if not fit.centres.shape[1]:  # nothing has been fitted or stored yet
            self.build(vectors)
            return
        fresh = new_path(self.spark, "vectors")
        usable = vectors.where(F.col("embedding").isNotNull() & F.exists("embedding", lambda x: x != 0))
        _placed(usable.select("id", "embedding"), fit).write.parquet(fresh)
        added = self.spark.read.parquet(fresh)
        changed = vectors.select("id").unionByName(gone.select("id")).distinct()
        rows = self.rows()
        held = rows.select("id", "cell").join(changed, "id", "left_semi").select("cell")
        touched = [r[0] for r in held.unionByName(added.select("cell")).distinct().collect()]
        kept = rows.where(F.col("cell").isin(touched)).join(changed, "id", "left_anti")
        merged = kept.where(F.col("embedding").isNotNull()).unionByName(added)
        # a row without a vector keeps an emptied cell in the overwrite
        _overwrite(merged.unionByName(self._empty(rows, touched)), f"{self.path}/cells")

    def search(
        self, queries: DataFrame, k: int, reach: float = REACH, scored: float = SCORED, **bounds: int
    ) -> DataFrame:
        """``(query_id, id, score, rank)``: cosine top-k of ``queries(query_id, embedding)``.

        Only folders of cells that some query reads are listed and scanned.
        """
        fit = self.fit
        rows, asked = self._read(queries, fit, reach)
        scorer = cell_scorer(fit, reach, scored)
        return exact_topk(rows, asked, scorer, k, DIGITS, query_bytes=F.size("embedding") * 8, **bounds)

    def _read(self, queries: DataFrame, fit: Fit, reach: float) -> tuple[DataFrame, DataFrame]:
        """The vectors of all cells that some query reads, and the queries."""
        asked = queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding")
        rows = self.rows().where(F.col("embedding").isNotNull())
        if not fit.centres.shape[1]:
            asked = asked.limit(0)
        cells = _cells_of(asked, fit, reach).distinct()
        few = [r[0] for r in cells.collect()]  # at most one a cell
        return rows.where(F.col("cell").isin(few)) if len(few) < len(fit.sizes) else rows, asked

    def _empty(self, like: DataFrame, cells: list[int]) -> DataFrame:
        """A row without a vector for each of some cells."""
        numbers = self.spark.createDataFrame([(c,) for c in cells], "cell int")
        nothing = (F.lit(None).cast(like.schema[c].dataType).alias(c) for c in ("id", "embedding", "code"))
        return numbers.select(*nothing, "cell")

    def _write(self, vectors: DataFrame, fit: Fit) -> None:
        placed = _placed(vectors, fit)
        placed = placed.unionByName(self._empty(placed, [0]))
        # by (cell, id), so a cell of very many vectors is written by many tasks
        placed.repartitionByRange(shuffle_partitions(self.spark), "cell", "id").write.partitionBy(
            "cell"
        ).mode("overwrite").parquet(f"{self.path}/cells")


def _overwrite(rows: DataFrame, path: str) -> None:
    """Replaces the partitions that ``rows`` falls into."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "cell"
    ).parquet(path)


def _placed(vectors: DataFrame, fit: Fit) -> DataFrame:
    schema = vectors.withColumn("code", F.lit(b"")).withColumn("cell", F.lit(0)).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, _ = unit_rows(pa.Table.from_batches([batch]))
            codes = [c.tobytes() for c in fit.code(unit)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(fit.cell(unit), pa.int32())],
                names=schema.names,
            )

    return vectors.mapInArrow(place, schema)


def _cells_of(queries: DataFrame, fit: Fit, reach: float) -> DataFrame:
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(len(fit.sizes), bool)
        for batch in batches:
            unit, usable = unit_rows(pa.Table.from_batches([batch]))
            if usable.any():
                wanted |= fit.plan(unit[usable], reach, None)[0].any(axis=0)
        yield pa.record_batch([pa.array(np.flatnonzero(wanted), pa.int32())], names=["cell"])

    return queries.select("embedding").mapInArrow(cells, "cell int")


def cell_scorer(fit: Fit, reach: float, scored: float) -> MakeScorer:
    """Cosine of each query with the vectors it scores; see ``Fit.plan``."""

    def make(queries: pa.Table) -> Prepare:
        wanted, wanted_ok = unit_rows(queries)
        near = _near(fit, wanted, wanted_ok, reach, scored)

        def prepare(items: pa.Table) -> Score:
            rows, _ = unit_rows(items)

            def score(k: int | None = None, digits: int = 0, reached: np.ndarray | None = None) -> Hits:
                for query, row in near(items):
                    scores = pair_scores(rows, wanted, row, np.full(len(row), query))
                    if k is not None:
                        best = highest(round_half_up(scores, digits), k)
                        row, scores = row[best], scores[best]
                    yield query, row, scores

            return score

        return prepare

    return make


def _near(
    fit: Fit, wanted: np.ndarray, usable: np.ndarray, reach: float, scored: float
) -> Callable[[pa.Table], Iterator[tuple[int, np.ndarray]]]:
    """Of a block of stored vectors, by query those that it scores."""
    reads, most = fit.plan(wanted, reach, scored) if wanted.shape[1] else (None, None)  # no query
    codes = fit.code(wanted) if wanted.shape[1] else None

    def near(items: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        if reads is None or not items.num_rows:
            return
        cell = items["cell"].to_numpy()
        stored = np.frombuffer(b"".join(items["code"].to_pylist()), np.uint8).reshape(len(cell), -1)
        order = np.argsort(cell, kind="stable")
        held, first = np.unique(cell[order], return_index=True)
        size = np.diff(np.append(first, len(cell)))
        place = np.empty(len(cell), np.int64)  # of each row's cell among those held
        place[order] = np.repeat(np.arange(len(held)), size)
        for start in range(0, len(reads), PLANNED_AT_ONCE):
            some = np.arange(start, min(start + PLANNED_AT_ONCE, len(reads)))
            some = some[usable[some]]
            able = distances(codes[some], stored) <= most[some, None]
            able &= reads[some][:, held][:, place]
            query, row = np.nonzero(able)
            edges = np.searchsorted(query, np.arange(len(some) + 1))
            for number, at in enumerate(some.tolist()):
                if edges[number] < edges[number + 1]:
                    yield at, row[edges[number] : edges[number + 1]]

    return near


def scored_share(cells: VectorCells, queries: DataFrame, reach: float = REACH, scored: float = SCORED) -> DataFrame:
    """``(query_id, n)``: how many vectors each query scores. They are counted where they are found."""
    fit = cells.fit
    rows, asked = cells._read(queries, fit, reach)
    schema = StructType([asked.schema["query_id"], StructField("n", LongType())])

    def counts(items: DataFrame, resident: pa.Table) -> DataFrame:
        def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted, usable = unit_rows(resident)
            near = _near(fit, wanted, usable, reach, scored)
            n = np.zeros(len(wanted), np.int64)
            for batch in batches:
                for query, row in near(pa.Table.from_batches([batch])):
                    n[query] += len(row)
            some = np.flatnonzero(n)
            names = resident["query_id"].combine_chunks().take(pa.array(some))
            yield pa.RecordBatch.from_arrays([names, pa.array(n[some])], names=schema.names)

        return items.mapInArrow(per_task, schema).groupBy("query_id").agg(F.sum("n").alias("n"))

    return by_query_blocks(rows.select("cell", "code"), asked, F.size("embedding") * 8, counts)
