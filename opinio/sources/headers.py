"""CSV files whose headers differ: equal headers are scanned together and united by name."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BAD = "bad_record"
# Bytes of a header line at most, headers read at once, and different headers at most.
HEADER_BYTES, AT_ONCE, MOST_HEADERS = 1 << 16, 16, 1000


def header_of(spark: SparkSession, file: str) -> str:
    """The first line of a file, without a byte order mark."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(path)
    try:
        limited = jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEADER_BYTES)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(limited, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def scan_csv_by_header(
    spark: SparkSession, path: str | list[str], schema: StructType, bad: str = BAD
) -> DataFrame:
    """The columns of ``schema`` from files that have them in any order, or lack some.

    Only headers are read first, a line a file; files of one header are one scan. A column
    that a file lacks is NULL, one that the schema lacks is left out. Names are compared without
    regard to case and surrounding white space. A record that does not fit its header or the
    types keeps its text in the column ``bad``, which is NULL for all others. Files without a
    line have no records.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    names = [row[0] for row in files.collect()]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        headers = list(pool.map(lambda name: header_of(spark, name), names))
    groups: dict[str, list[str]] = {}
    for name, header in zip(names, headers):
        if header.strip():
            groups.setdefault(header, []).append(name)
    if len(groups) > MOST_HEADERS:
        raise ValueError(f"{len(groups)} different headers")
    scans = [_scan(spark, header, some, schema, bad) for header, some in sorted(groups.items())]
    if not scans:
        return spark.createDataFrame([], StructType([*schema.fields, StructField(bad, StringType())]))
    return reduce(DataFrame.unionByName, scans)


def _scan(spark: SparkSession, header: str, files: list[str], schema: StructType, bad: str) -> DataFrame:
    known = {field.name.lower(): field for field in schema.fields}
    fields, taken = [], {}
    for place, name in enumerate(header.split(",")):
        name = name.strip().strip('"').strip()
        field = known.get(name.lower())
        # own names, so that a header may repeat one or use that of the bad records
        fields.append(StructField(f"c{place}", field.dataType if field else StringType()))
        if field:
            taken.setdefault(field.name, f"c{place}")
    reader = spark.read.schema(StructType([*fields, StructField("bad", StringType())])).option(
        "columnNameOfCorruptRecord", "bad"
    )
    rows = reader.csv(files, header=True, mode="PERMISSIVE", escape='"')
    return rows.select(
        *(
            (F.col(taken[f.name]) if f.name in taken else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ),
        F.col("bad").alias(bad),
    )
