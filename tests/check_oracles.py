"""Compare every registered query with its SQL: ``python tests/check_oracles.py SF_DIR [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from opinio.session import build_session  # noqa: E402

DUCKDB_TYPES = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return repr(value)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda row: tuple(map(str, row)))


def oracle_rows(folder: str, sql: str):
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    return rows_of(list(kinds), result.fetchall()), kinds


def compare(spark: SparkSession, folder: str, name: str) -> str | None:
    """None when equal, else what differs."""
    frame = contract.queries()[name](spark, folder)
    got = rows_of(frame.columns, frame.collect())
    want, kinds = oracle_rows(folder, contract.oracle_sql()[name])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    mine_kinds = {f.name: DUCKDB_TYPES[f.dataType.simpleString()] for f in frame.schema.fields}
    if mine_kinds != kinds:
        return f"types {mine_kinds} != {kinds}"
    for mine, theirs in zip(got[1], want[1]):
        if mine != theirs:
            return f"{mine!r:.600} != {theirs!r:.600}"
    return None


if __name__ == "__main__":
    session = build_session(
        "oracles", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:] or list(contract.queries())
    for name in names:
        begun = time.time()
        try:
            if name in contract.oracle_sql():
                verdict = compare(session, folder, name) or "MATCH"
            else:
                verdict = f"{contract.queries()[name](session, folder).count()} rows, no oracle"
        except Exception as problem:  # noqa: BLE001
            verdict = f"ERROR {problem!r:.1500}"
        print(f"{name:28} {time.time() - begun:6.1f}s {verdict}", flush=True)
