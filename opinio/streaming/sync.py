"""Index sync from change files: processes what has arrived, then stops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinio.operators.changes import latest_per_key
from opinio.operators.index import SEQUENCE as CHANGE
from opinio.operators.index import TextIndex

OP = "op"
SEQUENCE = "seq"


def sync_available(
    index: TextIndex,
    folder: str,
    schema: StructType | str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> int:
    """Apply all unread change files to the index; returns the number of batches.

    A change row holds the source columns, ``op`` (upsert or delete) and ``seq``;
    the highest ``seq`` of a key wins, in whatever batch it arrives: the index keeps it
    with the row or the deletion, and a change that comes late is dropped. So a batch that
    is replayed after a crash changes nothing that it has already done. Of the index only
    the buckets of the changed keys are read and written.
    """
    n_batches = 0
    reader = index.spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def apply(batch: DataFrame, number: int) -> None:
        nonlocal n_batches
        n_batches += not batch.isEmpty()
        last = latest_per_key(batch, index.key, SEQUENCE).withColumnRenamed(SEQUENCE, CHANGE)
        last = last.withColumn(CHANGE, F.col(CHANGE).cast("bigint"))
        gone = F.col(OP) == "delete"
        index.apply(last.where(~gone).drop(OP), last.where(gone).select(index.key, CHANGE))

    query = (
        reader.parquet(folder)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return n_batches
