"""Run queries and their SQL side by side and compare all rows:  python -m testbed.compare <folder> [names]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from testbed.queries import QUERIES
from testbed.sql_checks import CHECKS
from titlepulse.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return value + 0.0
    return value


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows], key=lambda row: [(v is None, str(v)) for v in row])


def difference(spark, con, name: str, folder: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    frame = QUERIES[name](spark, folder)
    mine = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(CHECKS[name])
    theirs_columns = [d[0] for d in cursor.description]
    theirs = comparable(theirs_columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(theirs_columns):
        return f"columns {sorted(frame.columns)} / {sorted(theirs_columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows / {len(theirs)} rows"
    unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(unequal)} of {len(mine)} rows, first {unequal[0]}" if unequal else None


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]")
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__} {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'BAD '} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal; without SQL: {sorted(set(QUERIES) - set(CHECKS))}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
