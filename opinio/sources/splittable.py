"""CSV with quoted line breaks, read by many tasks a file.

A line break ends a record only if the quotes before it are even in number. Every block of
a file counts its quotes; the sum over the blocks before tells each block whether it begins
inside quotes. So each task cuts its own records, and only what crosses a border between two
blocks, at most two pieces a block, is shuffled and put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinio.session import checked_broadcast, new_path
from opinio.sources.landing import LINEAGE

QUOTE = '"'
# Kinds of pieces. Of a block's torn records the rest comes before the begin.
WHOLE, REST, BEGIN, HEAD = 0, 1, 2, 3


def scan_csv_in_splits(
    spark: SparkSession, path: str | list[str], schema: StructType, lineage: bool = False
) -> DataFrame:
    """Records of CSV files with a header line, quoted line breaks and doubled quotes.

    Like ``landing.scan_csv(multi_line=True)`` with a schema, but a large file is shared by
    many tasks. Every quote character counts, also one inside a field without quotes. A file
    whose header does not name the columns in their order is refused. A record with values that
    do not fit has NULLs in their place; blank lines are no records.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.col("_metadata.file_modification_time").alias("time"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    stored = new_path(spark, "blocks")
    lines.groupBy("file", "at").agg(F.sum(quotes).alias("quotes")).write.parquet(stored)
    blocks = spark.read.parquet(stored)
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    odd = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int").alias("odd")
    begins = blocks.select("file", "at", odd)
    # a row a block of a file, counted; the lines of a block keep their order
    known = checked_broadcast(begins, blocks.count())
    cut = lines.join(known, ["file", "at"]).select("value", "file", "at", "time", "odd")
    pieces = cut.mapInArrow(
        _cut, "file string, at bigint, time timestamp, record string, part int"
    )
    heads = pieces.where(F.col("part") == HEAD).select("file", F.regexp_replace("record", "\r$", "").alias("head"))
    whole = pieces.where(F.col("part") == WHOLE).select("file", "at", "time", "record")
    torn = pieces.where(F.col("part").isin(REST, BEGIN))
    # a record's begin opens a group that the rests after it belong to
    order = Window.partitionBy("file").orderBy("at", "part")
    joined = (
        torn.withColumn("number", F.sum((F.col("part") == BEGIN).cast("int")).over(order))
        .groupBy("file", "number")
        .agg(
            F.min(F.struct("at", "part", "time")).alias("first"),
            F.sort_array(F.collect_list(F.struct("at", "part", "record"))).alias("parts"),
        )
        .select(
            "file",
            F.col("first.at").alias("at"),
            F.col("first.time").alias("time"),
            F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"),
        )
    )
    records = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    header = ",".join(f.name for f in schema.fields)
    parsed = F.from_csv(
        "record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
        {"escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"},
    )
    columns = [F.col("parsed")[f.name].alias(f.name) for f in schema.fields]
    if lineage:
        columns += [F.col("time").alias(LINEAGE[0]), F.col("file").alias(LINEAGE[1])]
    files = blocks.select("file").distinct()
    wrong = files.join(heads.where(F.col("head") == header), "file", "left_anti").first()
    if wrong is not None:
        raise ValueError(f"{wrong['file']}: its header is not {header}")
    rows = records.where(F.length("record") > 0)
    return rows.withColumn("parsed", parsed).select(*columns)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of some blocks as whole records, rests and begins of torn ones, and the header."""
    names = ["file", "at", "time", "record", "part"]
    here: tuple | None = None
    odd, waiting, resting, first = 0, [], False, False

    def out(key: tuple, records: list[str], parts: list[int]) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]] * n, pa.string()),
                pa.array([key[1]] * n, pa.int64()),
                pa.array([key[2]] * n, pa.timestamp("us", tz="UTC")),
                pa.array(records, pa.string()),
                pa.array(parts, pa.int32()),
            ],
            names=names,
        )

    for batch in batches:
        counts = pc.count_substring(batch.column("value"), QUOTE).to_numpy() % 2
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("file", "at", "time", "odd"))))
        values = batch.column("value").to_pylist()
        borders = [0, *(i for i in range(1, len(keys)) if keys[i][:2] != keys[i - 1][:2]), len(keys)]
        for a, b in zip(borders, borders[1:]):
            if a == b:
                continue
            if here is None or keys[a][:2] != here[:2]:
                if waiting:  # the block before ends inside a record
                    yield out(here, ["\n".join(waiting)], [REST if resting else BEGIN])
                here, waiting = keys[a], []
                odd = keys[a][3]
                resting, first = bool(odd), not keys[a][1]
            records, parts = [], []
            # quotes are even after a line that ends a record
            ends = (odd + np.cumsum(counts[a:b])) % 2 == 0
            start = a
            for i in (np.flatnonzero(ends) + a).tolist():
                waiting += values[start : i + 1]
                records.append("\n".join(waiting) if len(waiting) > 1 else waiting[0])
                parts.append(REST if resting else HEAD if first else WHOLE)
                waiting, resting, first, start = [], False, False, i + 1
            waiting += values[start:b]
            odd = int((odd + counts[a:b].sum()) % 2)
            if records:
                yield out(here, records, parts)
    if waiting:
        yield out(here, ["\n".join(waiting)], [REST if resting else BEGIN])
