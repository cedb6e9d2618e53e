"""Catalog tables: full-refresh writes, reads and properties."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from opinio.session import remove


def overwrite_table(
    rows: DataFrame,
    name: str,
    fmt: str | None = None,
    path: str | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Replace the table and its schema with ``rows``.

    With a ``path`` the rows go to a fresh folder below it first, and the table is then pointed
    there: a write that fails leaves the table as it was, and readers of the old folder finish;
    the folder before that one is removed. Without a path the table is the catalog's own and is
    overwritten in place. ``cluster_by`` deals the rows by those columns to tasks of even size,
    which bounds a task's sort, and sorts each task's output; a later point lookup on them
    skips files and parquet row groups.
    """
    if cluster_by:
        rows = rows.hint("rebalance", *cluster_by).sortWithinPartitions(*cluster_by)
    spark = rows.sparkSession
    fmt = fmt or spark.conf.get("spark.sql.sources.default")
    if path is None:
        rows.write.mode("overwrite").option("overwriteSchema", "true").format(fmt).saveAsTable(name)
        return
    base = path.rstrip("/")
    fresh = f"{base}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows.write.format(fmt).save(fresh)
    _point(spark, name, fmt, fresh, rows)
    for old in _versions(spark, base)[:-2]:
        remove(spark, f"{base}/{old}", base)


def _point(spark: SparkSession, name: str, fmt: str, location: str, rows: DataFrame) -> None:
    """Makes the table the files at ``location``; only the catalog is written."""
    if spark.catalog.tableExists(name):
        old = spark.read.table(name)
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        same = [(f.name, f.dataType) for f in old.schema.fields] == [
            (f.name, f.dataType) for f in rows.schema.fields
        ]
        if same and described.get("Provider", "").lower() == fmt.lower():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(name)
            return
        # another schema: the entry is replaced; an external table's files stay
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{location}'")


def _versions(spark: SparkSession, base: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(s.getPath().getName() for s in system.listStatus(folder) if s.getPath().getName().startswith("v-"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    """Store table properties. Parquet keeps them but gives them no effect."""
    pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.limit(n)
