"""A text index kept as plain parquet tables, partitioned by the hash of the key.

Layout under one path; all but the last two are partitioned by ``bucket``:

``rows``      source columns, row_hash, terms, n_terms, embedding, deleted, change_seq
``postings``  a row per block of a term's postings: entries (id, tf, n_terms), heaviest
              blocks first, with what bounds a block's weight: most_tf, least_terms
``stats``     a row per bucket: texts, terms, a sketch of the distinct terms, a check of the rows
``columns``   an empty table that has all columns of ``rows``
``cells``     vectors by nearest centre, from the first approximate search on

A sync joins the changes with the rows of the buckets they fall in and overwrites those
partitions; the other buckets are neither read nor written. Readers take the tables as
they are. Of a sync that failed between two tables the next one finds the buckets by their
checks and derives them again. Have one writer at a time. Source columns may be added; one
that changes its type is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from opinio.functions.counting import with_counts
from opinio.functions.text import hashed_vector
from opinio.operators.cells import VectorCells
from opinio.operators.changes import HASH, change_set, check_key, with_row_hash
from opinio.session import checked_broadcast, new_path, path_exists, remove

# The number of a change, kept with rows and deletions that came with one.
SEQUENCE = "change_seq"
BUCKET = "bucket"

# Rows and bytes of text a bucket is aimed at, and bounds of the number of buckets. A bucket is
# sorted and scored by one task.
ROWS_PER_BUCKET, BYTES_PER_BUCKET = 8_192, 16 << 20
FEWEST_BUCKETS, MOST_BUCKETS = 8, 4096
# Postings in a block.
BLOCK = 128
# Size of the sketch of terms (2 ** SKETCH registers): a relative error of about 0.4 percent.
SKETCH = 16

# text column -> array<float> column, such as a pandas UDF around a model
Embed = Callable[[Column], Column]




@dataclass(frozen=True)
class Totals:
    version: int  # changes applied since the build
    n_docs: int
    n_terms: int
    dimension: int
    n_buckets: int
    synced_at: datetime

    @property
    def mean_terms(self) -> float:
        return self.n_terms / self.n_docs if self.n_docs else 0.0


def with_vector(counted: DataFrame, text: str, embed: Embed | None) -> DataFrame:
    """Append ``embedding``: the caller's model on the text, or the hashed ``terms``."""
    vector = embed(F.col(text)) if embed else hashed_vector(F.col("terms"))
    return counted.withColumn("embedding", vector)


def analysed(rows: DataFrame, text: str, embed: Embed | None = None) -> DataFrame:
    """Rows with everything the index derives from a text; no shuffle."""
    if embed is None:
        return with_counts(rows, text)
    return with_counts(rows, text, None).withColumn("embedding", embed(F.col(text)))


@dataclass(frozen=True)
class Snapshot:
    """The index as it is now."""

    index: TextIndex
    totals: Totals

    def rows(self) -> DataFrame:
        """Live rows with their terms and vectors, and the bucket they are stored in."""
        return self.index.rows().where(~F.col("deleted")).drop("deleted", SEQUENCE)

    def bucket_of(self, key: Column) -> Column:
        return bucket_of(key, self.totals.n_buckets)

    def blocks(self) -> DataFrame:
        """Blocks of postings; a block's bounds can be read without its entries."""
        return self.index.stored("postings").where(F.col("term").isNotNull())

    def postings(self) -> DataFrame:
        """``(term, key, tf, n_terms)``."""
        entries = self.blocks().select("term", F.explode("entries").alias("_e"))
        return entries.select("term", F.col("_e.id").alias(self.index.key), "_e.tf", "_e.n_terms")

    def term_stats(self) -> DataFrame:
        """``(term, df)`` rows that add up to the document count of each term."""
        return self.blocks().select("term", F.col("n").alias("df"))

    def describe(self) -> DataFrame:
        """One row about the index; the distinct terms are estimated from the merged sketches."""
        totals = self.totals
        sketch = self.index.stored("stats").agg(F.hll_union_agg("term_sketch").alias("s"))
        return sketch.select(
            F.lit(totals.n_docs).cast("bigint").alias("n_docs"),
            F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).cast("bigint").alias("n_distinct_terms"),
            F.lit(totals.dimension).alias("dimension"),
            F.lit(totals.mean_terms).alias("mean_terms"),
            F.lit(totals.version).alias("version"),
            F.lit(totals.synced_at).alias("synced_at"),
        )

    def n_distinct_terms(self) -> DataFrame:
        """The exact figure: one row, ``n_distinct_terms``."""
        terms = self.term_stats().groupBy("term").agg(F.lit(1).alias("one"))
        return terms.agg(F.count(F.lit(1)).alias("n_distinct_terms"))

    def cells(self) -> VectorCells:
        """The vectors in cells; made at the first call and kept by every sync."""
        cells = VectorCells(self.index.spark, f"{self.index.path}/cells")
        if not cells.built:
            cells.build(self.rows().select(F.col(self.index.key).alias("id"), "embedding"))
        return cells


def bucket_of(key: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str
    key: str = "id"
    text: str = "review_text"
    embed: Embed | None = None
    n_buckets: int | None = None  # of a new index; by default from the number of its rows

    # -- reading ---------------------------------------------------------------

    def snapshot(self) -> Snapshot | None:
        """The index; None before the first build or sync."""
        stats = self.stored("stats")
        if stats is None:
            return None
        found = stats.agg(
            F.max("version").alias("version"),
            F.sum("n_docs").alias("n_docs"),
            F.sum("n_terms").alias("n_terms"),
            F.max("dimension").alias("dimension"),
            F.max("n_buckets").alias("n_buckets"),
            F.max("synced_at").alias("synced_at"),
        ).first()
        return Snapshot(self, Totals(**found.asDict()))

    def current(self) -> Snapshot:
        found = self.snapshot()
        if found is None:
            raise ValueError(f"no index at {self.path}")
        return found

    def stored(self, table: str) -> DataFrame | None:
        """A table as it is; None if nothing was written."""
        try:
            return self.spark.read.parquet(f"{self.path}/{table}")
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def rows(self) -> DataFrame:
        """All stored rows, deletions included, with every column that any of them has."""
        columns = self.stored("columns").schema
        with_bucket = StructType([*columns.fields, StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(with_bucket).parquet(f"{self.path}/rows")

    # -- writing ---------------------------------------------------------------

    def build(self, source: DataFrame) -> TextIndex:
        if self.snapshot() is not None:
            raise ValueError(f"{self.path} holds an index; sync it or choose a new path")
        self.apply(source)
        return self

    def sync(self, source: DataFrame) -> int:
        """Bring the index to ``source``; returns how many change sets it has seen since its build."""
        before = self.snapshot()
        if before is None:
            return self.apply(source)
        self._mend(before)
        known = before.rows().select(self.key, HASH)
        hashed = with_row_hash(source)
        # before anything is written: a NULL key would pass the diff and never be stored
        check_key(hashed, self.key)
        path = new_path(self.spark, "changes")
        change_set(known, hashed, self.key).write.parquet(path)
        changes = self.spark.read.parquet(path)
        n_changes = changes.count()
        if not n_changes:
            return before.totals.version
        gone = F.col("change") == "delete"
        wanted = checked_broadcast(changes.where(~gone).select(self.key), n_changes)
        fresh = source.join(wanted, self.key, "left_semi")
        return self.apply(fresh, changes.where(gone).select(self.key))

    def apply(self, upserts: DataFrame, deletes: DataFrame | None = None) -> int:
        """Upserts and deletions by key; returns the change sets seen since the build.

        Rows and deletions may carry ``change_seq``; it is kept with them, and a change whose
        number is not above that of its key is late and dropped. So a change set that is
        applied again changes nothing. Keys are checked before anything of the index is written.
        """
        before = self.snapshot()
        fresh = with_row_hash(upserts, but=SEQUENCE).withColumn("deleted", F.lit(False))
        if deletes is not None:
            named = [c for c in (self.key, SEQUENCE) if c in deletes.columns]
            gone = deletes.select(*named).withColumn("deleted", F.lit(True))
            fresh = fresh.unionByName(gone, allowMissingColumns=True)
        if SEQUENCE not in fresh.columns:
            fresh = fresh.withColumn(SEQUENCE, F.lit(None).cast("bigint"))
        if before is None:  # what a build that failed has left is no index
            for table in ("rows", "postings", "columns", "cells"):
                if path_exists(self.spark, f"{self.path}/{table}"):
                    remove(self.spark, f"{self.path}/{table}", self.path)
        columns = self.stored("columns")
        self._refuse_new_types(columns, fresh)

        scratch = [new_path(self.spark, "changes"), new_path(self.spark, "fresh")]
        fresh.write.parquet(scratch[0])
        changes = self.spark.read.schema(fresh.schema).parquet(scratch[0])
        check_key(changes, self.key)
        size = F.octet_length(F.col(self.text).cast("string")).cast("bigint")
        n_changes, n_bytes = changes.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
        n = before.totals.n_buckets if before else self._buckets_for(n_changes, n_bytes)
        changes = changes.withColumn(BUCKET, bucket_of(F.col(self.key), n))
        touched = [r[0] for r in changes.select(BUCKET).distinct().collect()] if before else list(range(n))
        old = None
        if before is not None:
            old = self.rows().where(F.col(BUCKET).isin(touched))
            newest = old.where(F.col(SEQUENCE).isNotNull()).select(
                self.key, F.col(SEQUENCE).alias("_newest")
            )
            late = F.col(SEQUENCE) <= F.col("_newest")
            changes = changes.join(newest, self.key, "left").where(~F.coalesce(late, F.lit(False)))
            numbered = F.coalesce(F.col(SEQUENCE), F.col("_newest"))
            changes = changes.withColumn(SEQUENCE, numbered).drop("_newest")
        # a bucket's changes are analysed by the task that writes them
        spread = changes.repartitionById(n, F.col(BUCKET))
        present = analysed(spread.where(~F.col("deleted")), self.text, self.embed)
        added = present.unionByName(spread.where("deleted"), allowMissingColumns=True)
        if old is not None:
            # needed more than once; a build writes it where it belongs
            added.write.parquet(scratch[1])
            added = self.spark.read.parquet(scratch[1])
            if not added.limit(1).count():  # all of it late: seen before
                self._derive(before, n, before.totals.version, self._stale(touched))
                return before.totals.version
            changed = checked_broadcast(added.select(self.key), n_changes)
            kept = old.join(changed, self.key, "left_anti")
            added = kept.unionByName(added, allowMissingColumns=True)
        self._grow(columns, added)
        version = before.totals.version + 1 if before else 0
        self._replace(added, "rows")
        if before is not None:
            self._refresh_cells(scratch[1])
        self._derive(before, n, version, touched)
        for path in scratch:
            remove(self.spark, path)
        return version

    # -- derived tables --------------------------------------------------------

    def _derive(self, before: Snapshot | None, n: int, version: int, touched: list[int]) -> None:
        """Postings and stats of some buckets from their rows."""
        if before is not None and not touched:
            return
        rows = self.rows().where(~F.col("deleted"))
        if before is not None:
            rows = rows.where(F.col(BUCKET).isin(touched))
        numbers = self.spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
        mean = rows.agg(F.avg("n_terms")).first()[0] or 1.0
        self._replace(self._blocked_postings(rows, n, mean).unionByName(
            # a row without a term keeps a bucket without postings in the overwrite
            numbers.select(BUCKET), allowMissingColumns=True
        ), "postings")
        terms = self.stored("postings").where(F.col(BUCKET).isin(touched)).groupBy(BUCKET).agg(
            F.hll_sketch_agg("term", SKETCH).alias("term_sketch")
        )
        counts = rows.groupBy(BUCKET).agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.sum("n_terms").cast("bigint").alias("n_terms"),
            F.max(F.size("embedding")).alias("dimension"),
            *_check(),
        )
        stats = (
            numbers.join(counts, BUCKET, "left")
            .join(terms, BUCKET, "left")
            .fillna(0, ["n_docs", "n_terms", "dimension", "check"])
            .withColumns(
                {
                    "version": F.lit(version),
                    "n_buckets": F.lit(n),
                    "synced_at": F.current_timestamp(),
                }
            )
        )
        # merged by many tasks, written by one
        self._replace(stats.repartition(1), "stats")

    def _blocked_postings(self, rows: DataFrame, n: int, mean: float) -> DataFrame:
        """Blocks of each bucket's terms, the postings of greatest weight first.

        The order only decides how tight the bounds are; they hold for any mean length.
        """
        entries = rows.select(
            BUCKET, F.col(self.key).alias("id"), "n_terms", F.explode("terms").alias("_t")
        ).select(BUCKET, "_t.term", "id", "_t.tf", "n_terms")
        damped = (F.lit(0.25) + F.lit(0.75) * F.col("n_terms") / F.lit(mean)) / F.col("tf")
        ordered = (
            entries.withColumn("_damped", damped)
            .repartitionById(n, F.col(BUCKET))
            .sortWithinPartitions(BUCKET, "term", "_damped", "id")
            .drop("_damped")
        )
        kind = entries.schema["id"].dataType.simpleString()
        schema = (
            f"{BUCKET} int, term string, block int, n int, most_tf int, least_terms int, "
            f"entries array<struct<id:{kind},tf:int,n_terms:int>>"
        )
        return ordered.mapInArrow(_blocks, schema)

    def _stale(self, buckets: list[int] | None = None) -> list[int]:
        """Buckets whose derived tables do not fit their rows."""
        rows = self.rows().where(~F.col("deleted"))
        stats = self.stored("stats").select(BUCKET, F.col("check").alias("noted"))
        if buckets is not None:
            rows, stats = (t.where(F.col(BUCKET).isin(buckets)) for t in (rows, stats))
        found = rows.groupBy(BUCKET).agg(*_check()).join(stats, BUCKET, "full")
        differs = F.coalesce("check", F.lit(0)) != F.coalesce("noted", F.lit(0))
        return [r[0] for r in found.where(differs).select(BUCKET).collect()]

    def _mend(self, before: Snapshot) -> None:
        """Derives again what a failed sync has left behind its rows."""
        stale = self._stale()
        if stale:
            cells = VectorCells(self.spark, f"{self.path}/cells")
            if cells.built:
                remove(self.spark, cells.path, self.path)  # the next approximate search makes them anew
            self._derive(before, before.totals.n_buckets, before.totals.version + 1, stale)

    def _refresh_cells(self, added: str) -> None:
        cells = VectorCells(self.spark, f"{self.path}/cells")
        if cells.built:
            changed = self.spark.read.parquet(added)
            gone = F.col("deleted")
            cells.upsert(
                changed.where(~gone).select(F.col(self.key).alias("id"), "embedding"),
                changed.where(gone).select(F.col(self.key).alias("id")),
            )

    # -- storage ---------------------------------------------------------------

    def _buckets_for(self, n_rows: int, n_bytes: int) -> int:
        wanted = max(FEWEST_BUCKETS, -(-n_rows // ROWS_PER_BUCKET), -(-n_bytes // BYTES_PER_BUCKET))
        return self.n_buckets or min(MOST_BUCKETS, wanted)

    def _replace(self, rows: DataFrame, table: str) -> None:
        """Overwrites the buckets that ``rows`` fall into."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            BUCKET
        ).parquet(f"{self.path}/{table}")

    def _refuse_new_types(self, columns: DataFrame | None, fresh: DataFrame) -> None:
        known = {f.name: f.dataType for f in columns.schema.fields} if columns is not None else {}
        for field in fresh.schema.fields:
            old = known.get(field.name, field.dataType)
            if old != field.dataType:
                raise ValueError(
                    f"{field.name} was {old.simpleString()}, is {field.dataType.simpleString()}"
                )

    def _grow(self, columns: DataFrame | None, rows: DataFrame) -> None:
        """Notes columns that no row has had so far."""
        rows = rows.drop(BUCKET)
        if columns is None or set(rows.columns) - set(columns.columns):
            known = columns.columns if columns is not None else []
            order = [*known, *(c for c in rows.columns if c not in known)]
            rows.limit(0).select(*order).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/columns"
            )


def _check() -> list[Column]:
    """A number that differs where the live rows of a bucket do."""
    return [F.bit_xor(F.xxhash64(HASH)).alias("check")]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings as blocks; what may still grow waits for the next batch."""
    held: pa.Table | None = None
    done = 0  # blocks of the first term held that have been given out

    def made(rows: pa.Table, done: int, last: bool) -> tuple[pa.RecordBatch | None, pa.Table | None, int]:
        bucket, n = rows[BUCKET].to_numpy(), rows.num_rows
        term = rows["term"].combine_chunks()
        new = np.ones(n, bool)
        differs = np.not_equal(bucket[1:], bucket[:-1])
        differs |= pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = differs
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        place = np.arange(n) - starts[run]
        block = place // BLOCK + np.where(run == 0, done, 0)
        begins = np.flatnonzero(place % BLOCK == 0)
        if not last:  # the last block waits
            rest = rows.slice(int(begins[-1]))
            carried = int(block[begins[-1]])
            begins, n = begins[:-1], int(begins[-1])
            if not len(begins):
                return None, rest, carried
            rows, block = rows.slice(0, n), block[:n]
        else:
            rest, carried = None, 0
        edges = np.append(begins, n)
        tf, length = rows["tf"].to_numpy(), rows["n_terms"].to_numpy()
        entries = pa.StructArray.from_arrays(
            [rows[c].combine_chunks() for c in ("id", "tf", "n_terms")], names=["id", "tf", "n_terms"]
        )
        first = pa.array(begins)
        batch = pa.RecordBatch.from_arrays(
            [
                rows[BUCKET].combine_chunks().take(first),
                rows["term"].combine_chunks().take(first),
                pa.array(block[begins], pa.int32()),
                pa.array(np.diff(edges), pa.int32()),
                pa.array(np.maximum.reduceat(tf, begins), pa.int32()),
                pa.array(np.minimum.reduceat(length, begins), pa.int32()),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), entries),
            ],
            names=[BUCKET, "term", "block", "n", "most_tf", "least_terms", "entries"],
        )
        return batch, rest, carried

    for batch in batches:
        if not batch.num_rows:
            continue
        some = pa.Table.from_batches([batch])
        held = some if held is None else pa.concat_tables([held, some])
        found, held, done = made(held, done, False)
        if found is not None:
            yield found
    if held is not None and held.num_rows:
        yield made(held, done, True)[0]
