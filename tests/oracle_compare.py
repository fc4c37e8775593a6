"""Compare registry queries with their DuckDB oracle SQL.

Usable from tests and as a script::

    python tests/oracle_compare.py /root/testdata/sf0.01 [name,name,...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from zonepulse.sources.tables import TEST_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TEST_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def duck_rows(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(row[i]) for i in order) for row in data]
    return cols, rows


def compare(spark, con, name, query, sql, sf_dir):
    s_cols, s_rows = spark_rows(query(spark, sf_dir))
    d_cols, d_rows = duck_rows(con, sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        cs, cd = Counter(s_rows), Counter(d_rows)
        if cs != cd:
            only_s = list((cs - cd).elements())[:3]
            only_d = list((cd - cs).elements())[:3]
            problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return len(s_rows), problems


def main(argv):
    from zonepulse.plans.oracle import ORACLE_SQL
    from zonepulse.plans.registry import QUERIES
    from zonepulse.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2].split(",") if len(argv) > 2 else [n for n in QUERIES if n in ORACLE_SQL]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            n, problems = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], sf_dir)
        except Exception as e:  # report and continue with the next query
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:500]}"]
        status = "OK  " if not problems else "FAIL"
        bad += bool(problems)
        print(f"{status} {name:28s} rows={n:7d} {'; '.join(problems)}", flush=True)
    missing = [n for n in QUERIES if n not in ORACLE_SQL]
    print(f"{len(names) - bad}/{len(names)} match; no oracle: {missing}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
