"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canon(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "∅"
        return f"{value:.6g}" if value != int(value) or abs(value) > 1e15 else str(int(value))
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in data)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = rows([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. extra={[r for r in got if r not in set(want)][:1]} missing={[r for r in want if r not in set(got)][:1]}"
    for g, w in zip(got, want):
        if g != w:
            bad = [(c, a[:300], b[:300]) for c, a, b in zip(got_cols, g, w) if a != b]
            return f"values differ: {g[0][:40]} {bad}"
    if not got:
        return "no rows"
    return None


def main(argv):
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from newsgrid.session import local_session

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8, "check")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    names = [n for n in entry.queries() if not argv or any(a in n for a in argv)]
    for name in names:
        start = time.time()
        try:
            if name in sqls:
                msg = compare(spark, con, entry.queries()[name], sqls[name], sf_dir)
            else:
                n = entry.queries()[name](spark, sf_dir).count()
                msg = None if n else "no rows"
        except Exception as exc:
            msg = f"{type(exc).__name__}: {str(exc)[:700]}"
        if msg:
            bad += 1
        if msg or time.time() - start > 2:
            print(f"{name:28s} {time.time() - start:5.1f}s {'ok' if not msg else 'FAIL ' + msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok, {sum(n in sqls for n in names)} with SQL")


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
