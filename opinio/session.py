"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Rows of keys (a key and at most one number) that may be broadcast, and bytes of their texts.
BROADCAST_KEYS, BROADCAST_BYTES = 2_000_000, 64 << 20


def build_session(app: str = "opinio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, ANSI casts and adaptive execution.

    Skew-join splitting stays on: the product/review join relies on it when one
    product owns a large share of the reviews.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset; it gets a folder in its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return base.rstrip("/")


_SCOPES: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, or in the scope that is open."""
    return f"{_SCOPES[-1] if _SCOPES else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession, name: str) -> Iterator[None]:
    """What ``new_path`` names inside is deleted at the end; results have to lie elsewhere.

    For one thread of the driver.
    """
    path = new_path(spark, name)
    _SCOPES.append(path)
    try:
        yield
    finally:
        _SCOPES.remove(path)
        if path_exists(spark, path):
            remove(spark, path)


def remove(spark: SparkSession, path: str, within: str | None = None) -> None:
    """Deletes a table of this library that nothing reads any more.

    It has to lie in the shared folder, where ``new_path`` has named it, or ``within``.
    """
    within = (within or shared_dir(spark)).rstrip("/")
    if not path.startswith(f"{within}/") or path == f"{within}/":
        raise ValueError(f"not in {within}: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checked_broadcast(keys: DataFrame, n_rows: int, most: int = BROADCAST_KEYS) -> DataFrame:
    """Broadcast a table of keys whose counted size allows it.

    The optimizer guesses the size of such a side from the files behind it and
    would often shuffle the large partner; beyond the bounds the choice is its own.
    Texts are measured as well, so ``keys`` should be stored or cheap.
    """
    if n_rows > most:
        return keys
    texts = [f.name for f in keys.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    if texts:
        size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(0))
        if (keys.agg(F.sum(size.cast("bigint"))).first()[0] or 0) > BROADCAST_BYTES:
            return keys
    return F.broadcast(keys)
