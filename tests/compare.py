"""Compare registered queries with their SQL counterparts, row for row.

Also a script: python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def _value(v):
    return float(v) if hasattr(v, "as_tuple") else v


def _rows(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(name, got, sql, con) -> str | None:
    """None if both sides return the same columns and rows, else what differs."""
    got_columns, got_rows = _rows(got.columns, got.collect())
    if sql is None:
        return None if got_rows else f"{name}: no rows"
    cursor = con.execute(sql)
    want_columns, want_rows = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"{name}: columns {got_columns} instead of {want_columns}"
    types = {d[0]: SPARK_TYPE.get(str(d[1]), str(d[1])) for d in cursor.description}
    if dict(got.dtypes) != types:
        return f"{name}: types {sorted(set(got.dtypes) ^ set(types.items()))}"
    extra, missing = got_rows - want_rows, want_rows - got_rows
    if extra or missing:
        return (
            f"{name}: {got_rows.total()} rows instead of {want_rows.total()}; "
            f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
        )
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from conftest import local_session

    spark, con, failed = local_session(), connect(sf_dir), 0
    sqls = oracle_sql()
    unknown = set(sqls) - set(queries())
    if unknown:
        print("SQL without query:", sorted(unknown))
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(name, run(spark, sf_dir), sqls.get(name), con)
        except Exception as error:  # report and go on with the next query
            problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.1f}s  {problem or name + ' ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
