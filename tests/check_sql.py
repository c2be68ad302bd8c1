"""Run every registered query that has one in Spark and its SQL twin in DuckDB, and compare the rows.

Usage: python tests/check_sql.py [sf or folder] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from patchlode.plans.fixtures import BASE_TABLES  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str, build, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = build(spark, sf_dir)
    columns = sorted(df.columns)
    mine = Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    if sorted(theirs_columns) != columns:
        return f"columns {columns} / {sorted(theirs_columns)}"
    order = [theirs_columns.index(c) for c in columns]
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    if mine == theirs:
        return None if mine else "no rows"
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"rows {sum(mine.values())} / {sum(theirs.values())}; only in Spark: "
        f"{list(only_mine.items())[:2]}; only in SQL: {list(only_theirs.items())[:2]}"
    )


def main() -> int:
    from patchlode.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    spark = build_session(
        "local[8]",
        "check",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    sqls, failed = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if name not in sqls or len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, build, sqls[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s", flush=True)
        if problem:
            failed.append(name)
            print("     ", problem, flush=True)
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
