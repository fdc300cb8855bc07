"""Compare a catalog query with its SQL: column names, row count and every value."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf, name)}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(normal(v) for v in value) + "]"
    if hasattr(value, "as_tuple"):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("\x1f".join(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, name, query, sql):
    """None if equal, else a short description of the difference."""
    df = query(spark, sf)
    mine = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        x, y = wrong[0]
        return f"{len(wrong)} rows differ, first:\n   {x[:300]!r}\n   {y[:300]!r}"
    if not mine:
        return "no rows"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from corpusloom.session import build_session

    scale, wanted = sys.argv[1], sys.argv[2:]
    sf = f"/root/testdata/sf{scale}"
    spark = build_session("parity", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) or w == queries[name].__module__.rsplit(".", 1)[-1] for w in wanted):
            continue
        t0 = time.time()
        try:
            if name in sql:
                result = compare(spark, con, sf, name, queries[name], sql[name])
            else:
                n = len(queries[name](spark, sf).collect())
                result = None if n else "no rows"
        except Exception as exc:
            result = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += result is not None
        kind = "sql" if name in sql else "rows"
        print(f"{'ok ' if result is None else 'BAD'} {name} [{kind}] {time.time() - t0:.1f}s {result or ''}", flush=True)
    print("bad:", bad)
