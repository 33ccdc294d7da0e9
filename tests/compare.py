"""Run named queries against their SQL in DuckDB and report differences. Also usable as a script."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_result(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return table_of([d[0] for d in cursor.description], cursor.fetchall())


def check(spark, con, sf_dir, query, sql):
    got, want = spark_result(query(spark, sf_dir)), duck_result(con, sql)
    if got[0] != want[0]:
        return f"columns {set(got[0]) ^ set(want[0])}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    if wrong:
        g, w = wrong[0]
        cells = [(n, a, b) for n, a, b in zip(got[0], g, w, strict=True) if a != b]
        return f"{len(wrong)} rows differ, first: {cells[:5]}"
    return "" if got[1] else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, sys.path[0] + "/..")
    from __spark_entry__ import oracle_sql, queries

    from siltline.session import local_session

    sf = sys.argv[1]
    chosen = sys.argv[2:] or list(queries())
    spark, con, sqls = local_session(8), connect(sf), oracle_sql()
    for name in chosen:
        start = time.time()
        try:
            problem = check(spark, con, sf, queries()[name], sqls[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:40s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
