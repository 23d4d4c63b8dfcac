"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from assayframe.catalog.base import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, int) and not isinstance(value, bool):
        return repr(value)
    return str(value) if value is not None else None


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple("" if v is None else str(v) + "!" for v in r))


SAME_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    spark_columns, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if spark_rows else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    duck_columns, duck_rows = rows_of(names, cursor.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} != {duck_columns}"
    for field in df.schema.fields:
        want = SAME_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString().upper())
        have = kinds[field.name].replace(", ", ",")
        if want != have and not want.startswith(("ARRAY", "STRUCT")):
            return f"type of {field.name}: {want} != {have}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)} rows"
    for mine, theirs in zip(spark_rows, duck_rows):
        if mine != theirs:
            return "\n  " + "\n  ".join(
                f"{c}: {a!r} != {b!r}" for c, a, b in zip(spark_columns, mine, theirs) if a != b)
    return None


def main() -> None:
    from session import make_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name in entry.queries():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if name in entry.oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} differ")
    spark.stop()


if __name__ == "__main__":
    main()
