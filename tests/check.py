"""Compare registered queries with their SQL: python tests/check.py [sf] [name ...]."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{root}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    return value


def key(row) -> tuple:
    return tuple((v is not None, f"{v:.3f}" if isinstance(v, float) else str(v)) for v in row)


def compare(df, con, sql: str) -> str:
    names = sorted(df.columns)
    ours = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=key)
    rel = con.execute(sql)
    theirs_names = [d[0] for d in rel.description]
    if sorted(theirs_names) != names:
        return f"columns {names} != {sorted(theirs_names)}"
    order = [theirs_names.index(n) for n in names]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if not ours:
        return "no rows"
    exact = sum(repr(a) == repr(b) for a, b in zip(ours, theirs))
    if exact == len(ours):
        return "ok"
    bad = next((a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b))
    return f"{len(ours) - exact} of {len(ours)} rows differ in {names}: {bad}"


def main() -> int:
    from quadrille.session import local_session
    from quadrille.workload import QUERIES, SQL

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    root = f"/root/testdata/sf{sf}"
    spark = local_session("3", 8)
    con = connect(root)
    names = sys.argv[2:] or list(QUERIES)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, root)
            said = compare(df, con, SQL[name]) if name in SQL else f"rows {df.count()} (no SQL)"
        except Exception as error:  # noqa: BLE001
            said = f"error {str(error)[:1200]}"
            if len(names) < 4:
                traceback.print_exc()
        if not (said == "ok" or "no SQL" in said):
            failed.append(name)
        print(f"{name:32s} {time.time() - start:6.2f}s {said[:1500]}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
