"""Run a registered query on Spark and its oracle SQL on DuckDB; compare like the driver does.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from strata.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, int | np.integer):
        return int(v)
    if isinstance(v, pd.Timestamp | dt.datetime):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, np.ndarray | list | tuple):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return str(v)


def canon(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records")] if len(df) else []
    rows.sort(key=repr)
    return cols, rows


def digest(rows) -> str:
    return hashlib.sha256(repr(rows).encode()).hexdigest()[:16]


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    from strata.plans.registry import ORACLES, QUERIES, load_all

    load_all()
    con = duck(sf_dir)
    out = {}
    for name in (names or sorted(QUERIES)):
        t0 = time.time()
        rec = {"oracle": name in ORACLES}
        try:
            sdf = QUERIES[name](spark, sf_dir).toPandas()
            rec["rows"] = len(sdf)
            if name in ORACLES:
                ddf = con.execute(ORACLES[name]).df()
                sc, sr = canon(sdf)
                dc, dr = canon(ddf)
                rec.update(oracle_rows=len(ddf), cols_match=sc == dc, hash_match=sr == dr)
                if sc != dc:
                    rec["cols"] = (sc, dc)
                elif sr != dr:
                    ss, ds = set(sr), set(dr)
                    rec["spark_only"] = list(ss - ds)[:3]
                    rec["oracle_only"] = list(ds - ss)[:3]
            rec["ok"] = rec.get("hash_match", True)
        except Exception as e:  # noqa: BLE001
            rec["ok"] = False
            rec["error"] = f"{type(e).__name__}: {str(e)[:600]}"
        rec["sec"] = round(time.time() - t0, 2)
        out[name] = rec
        if verbose:
            flag = "OK " if rec["ok"] else "BAD"
            print(flag, name, {k: v for k, v in rec.items() if k not in ("ok",)}, flush=True)
    return out


if __name__ == "__main__":
    from strata.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not v["ok"]]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
