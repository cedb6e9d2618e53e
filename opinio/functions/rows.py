"""Row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampType


def _printable(rows: DataFrame, name: str, read_as: str) -> Column:
    kind = rows.schema[name].dataType
    column = F.col(f"`{read_as}`")
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.to_json(column)
    if isinstance(kind, TimestampType):  # the same in every session time zone
        return F.unix_micros(column).cast("string")
    return column.cast("string")


def fingerprint(rows: DataFrame, columns: list[str], read_as: list[str] | None = None) -> Column:
    """md5 over the columns, each written as ``length:value`` and NULL as ``-``.

    ``read_as`` names them in the table it is used on, if other than in ``rows``. The lengths keep ("ab", "c") and ("a", "bc"), and NULL and "", apart.
    """
    parts = []
    for name, used in zip(columns, read_as or columns):
        text = _printable(rows, name, used)
        part = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(part, F.lit("-")))
    return F.md5(F.concat(*parts))
