"""Run a query in Spark and its check statement in DuckDB, and compare all rows exactly.

    python -m tests.compare /root/testdata/sf0.01 [name-prefix ...]
"""

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{directory}/{t}.parquet')")
    return con


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(r[n] for n in names) for r in df.collect())


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    raw = [d[0] for d in cur.description]
    names = sorted(raw)
    pos = [raw.index(n) for n in names]
    return names, Counter(tuple(r[p] for p in pos) for r in cur.fetchall())


def types_differ(left: Counter, right: Counter) -> str | None:
    """Column types as Python sees them: 1 and 1.0 compare equal but are not the same column type."""

    def kinds(rows):
        out = {}
        for row in rows:
            for i, v in enumerate(row):
                if v is not None:
                    out.setdefault(i, set()).add(type(v).__name__)
        return out

    a, b = kinds(left), kinds(right)
    return None if a == b else f"types {a} against {b}"


def difference(spark_rows, duck_rows) -> str | None:
    (sn, sc), (dn, dc) = spark_rows, duck_rows
    if sn != dn:
        return f"columns {sn} against {dn}"
    if sc != dc:
        left, right = sc - dc, dc - sc
        shown = "\n".join(f"  spark {a}\n  check {b}" for a, b in zip(sorted(left, key=str)[:3], sorted(right, key=str)[:3]))
        return f"{sum(sc.values())} and {sum(dc.values())} rows, {sum(left.values())} differ on {sn}\n{shown}"
    return types_differ(sc, dc)


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tillwise.session import local_session

    directory, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark, con, checks = local_session(8), connect(directory), oracle_sql()
    bad = []
    for name, run in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t0 = time.time()
        try:
            got = rows_of_spark(run(spark, directory))
            t1 = time.time()
            verdict = difference(got, rows_of_duck(con, checks[name])) if name in checks else "(no statement)"
            n = sum(got[1].values())
        except Exception as e:  # report and go on with the next query
            t1, verdict, n = time.time(), f"{type(e).__name__}: {str(e)[:900]}", -1
        if verdict not in (None, "(no statement)"):
            bad.append(name)
        print(f"{name:28s} {n:7d} rows {t1 - t0:6.2f}s + {time.time() - t1:5.2f}s  {verdict or 'ok'}", flush=True)
    print("FAILED", bad)
