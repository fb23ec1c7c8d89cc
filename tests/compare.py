"""Compare a registered Spark query with its DuckDB oracle.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon_rows(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def spark_type_to_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(t, t.upper())


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> dict:
    t0 = time.perf_counter()
    df = query(spark, sf_dir)
    s_cols = [f.name for f in df.schema.fields]
    s_types = [spark_type_to_duck(f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.perf_counter()
    out = {"query": name, "rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = [str(t).replace(" ", "") for t in rel.types]
    d_rows = rel.fetchall()
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        bad = [(c, a, b) for c, a, b in zip(s_cols, s_types, d_types) if a != b]
        if bad:
            problems.append(f"types {bad}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rowcount spark={len(s_rows)} duck={len(d_rows)}")
    if s_cols == d_cols:
        a, b = canon_rows(s_rows), canon_rows(d_rows)
        if a != b:
            sa, sb = set(a), set(b)
            only_s = sorted(sa - sb, key=str)[:3]
            only_d = sorted(sb - sa, key=str)[:3]
            problems.append(f"values differ: {len(sa - sb)} spark-only e.g. {only_s}; duck-only e.g. {only_d}")
    out["status"] = "ok" if not problems else "FAIL"
    if problems:
        out["problems"] = problems
    return out


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tillbook.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session(shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    names = wanted or list(qs)
    failures = 0
    for name in names:
        try:
            res = compare(spark, con, sf_dir, name, qs[name], sqls.get(name))
        except Exception as exc:  # noqa: BLE001
            res = {"query": name, "status": "ERROR", "error": str(exc)[:800]}
        failures += res["status"] in ("FAIL", "ERROR")
        print(res, flush=True)
    print(f"{len(names) - failures}/{len(names)} passed")


if __name__ == "__main__":
    main()
