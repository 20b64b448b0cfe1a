"""Compare registered queries with their SQL in DuckDB.

Run as a script to check a folder: `python tests/compare.py FOLDER [name ...]`.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if rows, column names and types agree, else what differs."""
    names = sorted(df.columns)
    got = _sorted([tuple(_plain(r[n]) for n in names) for r in df.collect()])
    rel = db.sql(sql)
    types = dict(zip(rel.columns, map(str, rel.types)))
    if sorted(types) != names:
        return f"columns {names} != {sorted(types)}"
    wrong = {n: (t, types[n]) for n, t in df.dtypes if TYPES.get(t, t) != types[n]}
    if wrong:
        return f"types {wrong}"
    cols = ", ".join(f'"{n}"' for n in names)
    want = _sorted([tuple(_plain(v) for v in r) for r in db.sql(f"select {cols} from ({sql})").fetchall()])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, e.g. {names}: {bad[0]}" if bad else None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from offerloom.session import local_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    db = database(folder)
    sqls = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sqls:
                result = difference(df, db, sqls[name])
                note = "ok" if result is None else result
            else:
                result, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            result = note = f"{type(error).__name__}: {str(error)[:600]}"
        if result is not None:
            failed.append(name)
        print(f"{name:26s} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
