"""Compares registered queries with their SQL in DuckDB: python tests/compare.py [folder] [name...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return plain(v.item())
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False)), key=repr)


def tables(folder: str):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def differences(spark, folder: str, names=None) -> dict[str, str]:
    import __spark_entry__ as entry

    queries, sql, c = entry.queries(), entry.oracle_sql(), tables(folder)
    out = {}
    for name in names or queries:
        began = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            if name not in sql:
                print(f"rows  {name}: {len(got)} rows, {time.time() - began:.1f} s", flush=True)
                continue
            want = c.execute(sql[name]).df()
            a, b = rows_of(got), rows_of(want)
            if a != b:
                extra = [r for r in a[1] if r not in set(b[1])][:2] if len(a[1]) < 50000 else []
                lack = [r for r in b[1] if r not in set(a[1])][:2] if len(b[1]) < 50000 else []
                out[name] = f"columns {a[0]} {b[0]}; rows {len(a[1])} {len(b[1])}; only ours {extra}; only SQL {lack}"
        except Exception as e:  # noqa: BLE001
            out[name] = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'DIFF' if name in out else 'ok'}  {name}, {time.time() - began:.1f} s {out.get(name, '')}", flush=True)
    return out


if __name__ == "__main__":
    from korale.session import local_session

    spark = local_session(4)
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    names = sys.argv[2:] or [n for n in entry.queries() if n[0] != "p" or "_found" not in n and not n[1].isdigit() or n[1:3].isdigit()]
    bad = differences(spark, folder, names)
    print(len(names), "queries,", len(bad), "differ")
