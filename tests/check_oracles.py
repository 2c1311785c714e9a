"""Run the registered queries and their SQL side by side: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def normal(rows, columns):
    """Named and typed columns in name order, rows in any order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(r[i] for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r]
    )


def expected(con, sql):
    cursor = con.execute(sql)
    columns = [(d[0], TYPES.get(str(d[1]), str(d[1]))) for d in cursor.description]
    return normal(cursor.fetchall(), columns)


def actual(df):
    return normal([tuple(r) for r in df.collect()], df.dtypes)


def main():
    from tests.conftest import make_session

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark, con, bad = make_session(), open_tables(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            got = actual(e.queries()[name](spark, sf_dir))
            sql = e.oracle_sql().get(name)
            if sql is None:
                verdict = "rows only"
            else:
                want = expected(con, sql)
                verdict = "ok" if got == want else "DIFFERENT"
                if got != want:
                    bad += 1
                    print(got[0], got[1][:3], "\n", want[0], want[1][:3], len(want[1]))
        except Exception as error:
            bad += 1
            got, verdict = ([], []), f"ERROR {str(error)[:1500]}"
        print(f"{name:28} {len(got[1]):7} rows {time.time() - start:6.2f} s  {verdict}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
