"""Run registered queries next to their SQL: python -m tests.check [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.9g}"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, build, sql: str) -> tuple[bool, str, int]:
    """Whether both sides hold the same columns and rows, the first difference, and the row count."""
    df = build(spark, folder)
    mine = rows_of(df.columns, df.collect())
    result = con.sql(sql)
    theirs = rows_of(result.columns, result.fetchall())
    if sorted(df.columns) != sorted(result.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(result.columns)}", len(mine)
    if mine == theirs:
        return True, "", len(mine)
    only_mine, only_theirs = sorted(set(mine) - set(theirs))[:2], sorted(set(theirs) - set(mine))[:2]
    return False, f"{len(mine)} / {len(theirs)} rows; only Spark {only_mine}; only SQL {only_theirs}", len(mine)


def main() -> None:
    import __spark_entry__ as entry
    from supportlens.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(**{
        "spark.master": "local[8]", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    con, oracles = connect(folder), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                ok, note, n = compare(spark, con, folder, build, oracles[name])
            else:
                ok, note, n = True, "no SQL", len(build(spark, folder).collect())
        except Exception as error:  # noqa: BLE001
            ok, note, n = False, f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:40s} {n:7d} rows {time.time() - start:6.1f}s {note[:900]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
