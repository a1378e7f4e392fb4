"""Run the named queries beside their SQL statements and report every difference.

usage: python tools/compare.py FOLDER [NAME ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from formline.suite import QUERIES  # noqa: E402


def sql_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns: list[str], rows) -> list[tuple]:
    """Rows as sorted tuples, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark: SparkSession, connection, name: str, folder: str) -> str | None:
    """None when both agree exactly, types included."""
    result = QUERIES[name](spark, folder)
    got = canonical(result.columns, [tuple(row) for row in result.collect()])
    if QUERIES[name].sql is None:
        return None if got else "no rows"
    relation = connection.sql(QUERIES[name].sql)
    want = canonical(relation.columns, relation.fetchall())
    if sorted(result.columns) != sorted(relation.columns):
        return f"columns {sorted(result.columns)} against {sorted(relation.columns)}"
    types = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}
    sql_types = {c: types.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    if dict(result.dtypes) != sql_types:
        return f"types {[(c, k, sql_types[c]) for c, k in result.dtypes if k != sql_types[c]]}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, e.g. {bad[:2]}" if bad else None


def main() -> None:
    folder, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = sql_tables(folder), 0
    for name in chosen:
        start = time.time()
        try:
            found = difference(spark, connection, name, folder)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")


if __name__ == "__main__":
    main()
