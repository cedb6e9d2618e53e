"""Exact top-k by inner product without random access: sorted lists read in step.

Vectors are dealt into shards. A shard keeps one list per dimension, sorted by the
component. For a query the lists are read from their best end, some entries of each in
turn. What has been read of a vector bounds its score from below (unread components count
as the list's worst) and from above (as the entry read last). Reading stops when no more
than a few vectors can still reach the k-th lower bound; their final scores are resolved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from opinio.llm.common import stored
from opinio.session import new_path

SCALE = 1024
SHARD = 4096
# Queries that travel with one pass over the shards.
QUERIES = 4096
# Entries read of each list between two tests, and vectors whose final scores are resolved.
READ, FEW = 512, 256


# Bytes of a score beyond 64 bits where it is ranked: room for any sum of products of doubles.
WIDE = 264


def finite(vector: Column) -> Column:
    """The vector, NULL for vectors that take no part."""
    usable = F.forall(
        vector,
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)
        ),
    )
    return F.when(usable & (F.size(vector) > 0), vector)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of finite components: as int64, or as Python integers if one is too large."""
    plain = vectors.astype(np.float64)
    with np.errstate(over="ignore"):
        whole = np.floor(plain * SCALE)
    if not whole.size or np.abs(whole).max() < 2.0**62:
        return whole.astype(np.int64)
    made = np.empty(plain.size, object)
    # from 2**60 on a double is a whole number
    made[:] = [
        int(x) * SCALE if abs(x) >= 2.0**60 else int(y)
        for x, y in zip(plain.ravel().tolist(), whole.ravel().tolist())
    ]
    return made.reshape(plain.shape)


def largest(numbers: np.ndarray) -> int:
    return max(-int(numbers.min()), int(numbers.max())) if numbers.size else 0


def room(numbers: np.ndarray) -> np.ndarray:
    """Python integers as int64 if all fit."""
    return numbers.astype(np.int64) if largest(numbers) < 1 << 62 else numbers


class Shard:
    """The sorted lists of some vectors: per dimension their order and components."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix  # vectors x dimensions
        self.largest = largest(matrix)
        if matrix.dtype == object:  # no lists: see ``near``
            return
        rising = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
        # every list twice: from its low end, then from its high end
        self.order = np.concatenate([rising, rising[:, ::-1]]).astype(np.intp)
        self.values = np.take_along_axis(np.tile(matrix.T, (2, 1)), self.order, 1)
        self.floats = self.values.astype(np.float64)
        # where in a list a vector stands: tells whether it has been read by a given depth
        places = np.empty(rising.shape, np.int16 if len(matrix) < 1 << 15 else np.int32)
        np.put_along_axis(places, rising, np.arange(len(matrix), dtype=places.dtype)[None], 1)
        self.places = np.concatenate([places, len(matrix) - 1 - places])

    def candidates(self, query: np.ndarray, k: int, skip: int | None) -> np.ndarray:
        """Rows that hold the best k, all ties of the k-th included; ``skip`` takes no part.

        Sums are exact: in float64 below 2**53, in int64 below 2**63. Beyond, the lists are
        not read and ``near`` decides.
        """
        n, dimensions = self.matrix.shape
        used = np.flatnonzero(query)
        everyone = np.arange(n) if skip is None else np.delete(np.arange(n), skip)
        if n <= FEW or not len(used):
            return everyone
        # no sum below is more than four times the largest score
        sums = 4 * self.reach(query)
        if sums >= 1 << 63:
            return self.near(query, k, everyone)
        number = np.float64 if sums < 1 << 53 else np.int64
        none = -np.inf if number is np.float64 else np.iinfo(np.int64).min
        weight = query[used].astype(number)
        # every list from its best end: the high one for a positive weight
        lists = np.where(weight > 0, used + dimensions, used)
        values = self.floats if number is np.float64 else self.values
        worst = weight * values[lists, -1]
        lower = np.full(n, worst.sum(), number)
        able = everyone
        for start in range(0, n, READ):
            stop = min(start + READ, n)
            order = self.order[lists, start:stop]
            more = weight[:, None] * values[lists, start:stop]
            more -= worst[:, None]
            if number is np.float64:
                lower += np.bincount(order.ravel(), more.ravel(), minlength=n)
            else:
                np.add.at(lower, order.ravel(), more.ravel())
            bounds = lower
            if skip is not None:
                bounds = lower.copy()
                bounds[skip] = none
            kth = np.partition(bounds, n - k)[n - k] if n > k else none
            last = weight * values[lists, stop - 1]
            # while a vector that no list has shown could still qualify, no test can end this
            if last.sum() < kth or stop == n:
                # what has been ruled out stays out: bounds only draw closer
                places = self.places[lists] if len(able) > n // 2 else self.places[lists[:, None], able]
                some = able if places.shape[1] < n else np.arange(n)
                unread = (places >= stop).astype(number)
                upper = lower[some] + (last - worst) @ unread
                able = some[upper >= kth] if some is able else able[upper[able] >= kth]
                if len(able) <= max(FEW, k):
                    break
        return able if skip is None else able[able != skip]

    def best(self, query: np.ndarray, ids: np.ndarray, k: int, skip: int | None) -> np.ndarray:
        """Rows of the best k by score, then id; and their scores."""
        rows = self.candidates(query, k, skip)
        if self.reach(query) < 1 << 63:
            scores = self.matrix[rows].astype(np.int64, copy=False) @ query.astype(np.int64, copy=False)
            order = np.lexsort((rows, ids[rows], -scores))[:k]
        else:
            scores = self.matrix[rows].astype(object) @ query.astype(object)
            order = sorted(range(len(rows)), key=lambda i: (-scores[i], ids[rows[i]], rows[i]))[:k]
            order = np.array(order, np.int64)
        return rows[order], scores[order]

    def reach(self, query: np.ndarray) -> int:
        """No score is beyond this."""
        return self.largest * largest(query) * len(query)

    def near(self, query: np.ndarray, k: int, rows: np.ndarray) -> np.ndarray:
        """Those of ``rows`` that can be among the best k, by rounded scores and their error."""
        try:
            matrix, weight = self.matrix[rows].astype(np.float64), query.astype(np.float64)
        except OverflowError:
            return rows
        with np.errstate(over="ignore", invalid="ignore"):
            about = matrix @ weight
            error = np.abs(matrix) @ np.abs(weight) * ((len(query) + 8) * 2.0**-51)
        if len(rows) <= k or not np.isfinite(about).all() or not np.isfinite(error).all():
            return rows
        kth = np.partition(about - error, len(rows) - k)[len(rows) - k]
        return rows[about + error >= kth]


def _matrix(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, dimensions)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec: str = "vec_id",
    embedding: str = "embedding",
    shard: int = SHARD,
    queries: int = QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row its k best other rows.

    Scores are integer inner products of floor(1024 x); ties go to the smaller id. NULL
    vectors, empty ones, NULL ids and components that are NULL or not finite take no part.
    Vectors of another length are no candidates. A score among the best k that a bigint
    cannot hold raises an error.
    Repeated rows are rows of their own, as queries and as candidates.

    Shards stay where they are. Query rows are read in blocks of at most ``queries``;
    a block travels with one pass over all shards, which returns at most k rows for
    each query and shard. Two rankings, per part of the shards and then whole, keep
    any one query's rows small.
    """
    spark = vectors.sparkSession
    single = vectors.schema[embedding].dataType.elementType == FloatType()
    kind = "<f4" if single else "<f8"
    components = F.col(embedding) if single else F.col(embedding).cast("array<double>")
    rows = (
        vectors.where(F.col(vec).isNotNull())
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col(vec).cast("bigint").alias("id"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            finite(components).alias("v"),
        )
        .where(F.col("v").isNotNull())
    )
    rows = stored(rows.withColumn("size", F.size("v")), "vectors")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    n_shards = max(1, -(-n // shard))
    n_blocks = max(1, -(-n_queries // queries))
    path = new_path(spark, "queries")
    asked = rows.where("asks").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
    asked.select("row", "id", "v", "size", "block").write.partitionBy("block").parquet(path)

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(n_shards)))
    packed = stored(
        dealt.groupBy("size", "shard").applyInArrow(
            lambda key, t: pa.table(
                {
                    "shard": pa.array([key[1].as_py()], pa.int64()),
                    "size": pa.array([key[0].as_py()], pa.int32()),
                    "rows": pa.array([t["row"].to_numpy().tobytes()], pa.binary()),
                    "ids": pa.array([t["id"].to_numpy().tobytes()], pa.binary()),
                    "matrix": pa.array(
                        [_matrix(t["v"], key[0].as_py()).astype(kind).tobytes()], pa.binary()
                    ),
                }
            ),
            "shard bigint, size int, rows binary, ids binary, matrix binary",
        ),
        "shards",
    ).repartition(n_shards, "shard", "size")
    schema = (
        "query_row bigint, query_id bigint, shard bigint, row bigint, vec_id bigint, "
        # a score that no bigint holds: its sign, and its digits in the order of binaries
        "score bigint, beyond bigint, wide binary"
    )

    def search(block: pa.Table) -> DataFrame:
        travelling = spark.sparkContext.broadcast(block)

        def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for one in batch.to_pylist():
                    yield within(one, travelling.value)

        return packed.mapInArrow(per_shard, schema)

    def within(one: dict, block: pa.Table) -> pa.RecordBatch:
        size = one["size"]
        numbers = np.frombuffer(one["rows"], np.int64)
        ids = np.frombuffer(one["ids"], np.int64)
        lists = Shard(scaled(np.frombuffer(one["matrix"], kind).reshape(-1, size)))
        place = {number: i for i, number in enumerate(numbers.tolist())}
        columns: list[list] = [[] for _ in range(8)]
        fits = np.flatnonzero(block["size"].to_numpy() == size)
        asked_of = scaled(_matrix(block["v"].take(pa.array(fits)), size))
        for at, query in zip(fits.tolist(), asked_of):
            own = block["row"][at].as_py()
            found, scores = lists.best(room(query), ids, k, place.get(own))
            for column, value in zip(columns[:3], (own, block["id"][at].as_py(), one["shard"])):
                column.extend([value] * len(found))
            columns[3].extend(numbers[found].tolist())
            columns[4].extend(ids[found].tolist())
            for score in scores.tolist():
                fit = -(1 << 63) <= score < 1 << 63
                columns[5].append(score if fit else None)
                columns[6].append(0 if fit else 1 if score > 0 else -1)
                columns[7].append(None if fit else (score + (1 << 8 * WIDE - 1)).to_bytes(WIDE))
        names = ["query_row", "query_id", "shard", "row", "vec_id", "score", "beyond", "wide"]
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    table = spark.read.schema(asked.select("row", "id", "v", "size", "block").schema).parquet(path)
    if n_blocks == 1:
        found = search(table.toArrow())
    else:
        target = new_path(spark, "hits")
        for number in range(n_blocks):
            block = table.where(F.col("block") == number).toArrow()
            search(block).write.mode("append").parquet(target)
        found = spark.read.schema(schema).parquet(target)

    order = [F.desc("beyond"), F.desc("score"), F.desc("wide"), F.asc("vec_id"), F.asc("row")]
    held = F.when(F.col("beyond") == 0, F.col("score")).otherwise(
        F.raise_error(F.lit("a score among the best is too large for a bigint")).cast("bigint")
    )
    part = Window.partitionBy("query_row", (F.col("shard") % 64).alias("part")).orderBy(*order)
    whole = Window.partitionBy("query_row").orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    return (
        first.withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", held.alias("score"))
    )
