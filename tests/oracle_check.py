"""Compare every query with its SQL counterpart: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_point  # noqa: E402
from marketlens.registry import GIVEN_TABLES  # noqa: E402
from marketlens.session import build_session  # noqa: E402


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else number
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in GIVEN_TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def compare(spark, db, sf_dir: str, name: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    frame = entry_point.queries()[name](spark, sf_dir)
    columns, mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(entry_point.oracle_sql()[name])
    other_columns, other = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if columns != other_columns:
        return f"columns {columns} vs {other_columns}"
    if len(mine) != len(other):
        return f"{len(mine)} rows vs {len(other)}; only mine {list(set(mine) - set(other))[:2]}; only sql {list(set(other) - set(mine))[:2]}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{str(a)[:400]} vs {str(b)[:400]}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    names = sys.argv[2:] or list(entry_point.queries())
    failed = 0
    for name in names:
        started = time.time()
        try:
            if name in entry_point.oracle_sql():
                problem = compare(spark, db, sf_dir, name)
            else:
                problem = None if entry_point.queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
