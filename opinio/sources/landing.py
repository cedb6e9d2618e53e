"""CSV landing files.

The default read takes one line per record and infers the schema, which costs a
pass over the files. ``schema`` saves that pass and fixes the types;
``multi_line`` reads quoted line breaks and doubled quotes correctly, at the
price of unsplittable files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LINEAGE = ("file_modification_time", "file_path")


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    multi_line: bool = False,
    sampling_ratio: float | None = None,
    check_header: bool | None = None,
) -> DataFrame:
    """Read one file, a folder or a glob of CSV files with a header line.

    ``check_header`` refuses a file whose header does not name the columns in their
    order, instead of mislabelling them; by default where a schema is given.
    """
    reader = spark.read.option("header", True)
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
    if check_header or (check_header is None and schema is not None):
        reader = reader.option("enforceSchema", False)
    return reader.csv(path)


def with_lineage(files: DataFrame) -> DataFrame:
    """Append the modification time and path of the file each row came from."""
    return files.select("*", *[F.col(f"_metadata.{name}") for name in LINEAGE])


def source_files(bronze: DataFrame) -> DataFrame:
    """The distinct files a bronze table was loaded from."""
    return distinct_values(bronze, "file_path")


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct()


def join_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"
