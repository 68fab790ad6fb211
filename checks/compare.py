"""Compare every query with its SQL counterpart on one data folder.

    python -m checks.compare [folder] [name ...]
"""

import datetime
import glob
import math
import os
import sys
import time

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    kept = [tuple(plain(row[i]) for i in order) for row in rows]
    return names, sorted(kept, key=repr)


def spark_rows(df):
    return table_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, text):
    cursor = con.execute(text)
    columns = [d[0] for d in cursor.description]
    return table_rows(columns, cursor.fetchall())


def difference(ours, theirs):
    """None when equal, else a short description."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1], strict=True) if a != b or types(a) != types(b)]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    return None


def types(row):
    return [type(v).__name__ for v in row]


def main(folder="/root/testdata/sf0.01", *names):
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from gridmill.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            ours = spark_rows(QUERIES[name](spark, folder))
            problem = "no oracle" if name not in ORACLES else difference(ours, sql_rows(con, ORACLES[name]))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            ours = ([], [])
        verdict = "ok" if problem is None else problem
        failed += problem not in (None, "no oracle")
        print(f"{name:22s} {len(ours[1]):7d} rows {time.time() - started:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(*sys.argv[1:])
