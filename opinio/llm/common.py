"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.session import new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    Cuts the lineage: a lost executor costs the tasks that read, not those that wrote.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(key: str, n: int) -> Column:
    """crc32 of a key printed as text, modulo n."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n
