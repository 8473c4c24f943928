"""Compare registered Spark queries with their DuckDB oracles, like the driver.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows spark/oracle, first difference.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        if v.is_integer() and abs(v) < 2 ** 53:
            return str(int(v))  # whole numbers of a column with nulls come as doubles
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_hash(pdf: pd.DataFrame) -> tuple[int, str, list[str]]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest(), rows


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
            n_s, h_s, rows_s = frame_hash(spdf)
            if name not in sql:
                out[name] = ("rows-only", n_s, None, "")
            else:
                opdf = con.execute(sql[name]).df()
                n_o, h_o, rows_o = frame_hash(opdf)
                same_cols = sorted(spdf.columns) == sorted(opdf.columns)
                status = "OK" if (same_cols and h_s == h_o) else "MISMATCH"
                diff = ""
                if not same_cols:
                    diff = f"cols spark={sorted(spdf.columns)} oracle={sorted(opdf.columns)}"
                elif h_s != h_o:
                    a, b = set(rows_s) - set(rows_o), set(rows_o) - set(rows_s)
                    diff = f"spark-only={sorted(a)[:2]} oracle-only={sorted(b)[:2]}"
                out[name] = (status, n_s, n_o, diff)
        except Exception as e:  # report and go on
            out[name] = ("ERROR", None, None, repr(e)[:400])
        if verbose:
            s = out[name]
            print(f"{name:28s} {s[0]:9s} spark={s[1]} oracle={s[2]} {time.time() - t0:5.1f}s {s[3]}",
                  flush=True)
    return out


if __name__ == "__main__":
    from basketlens.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] in ("MISMATCH", "ERROR")]
    print("FAILED:", bad if bad else "none")
