"""Run queries against their SQL and report differences.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = frame[c].dtype
        if kind == object or str(kind).startswith(("str", "string")):
            frame[c] = frame[c].map(lambda v: None if pd.isna(v) else str(v)).astype(object)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    kinds = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns
             if str(got[c].dtype) != str(want[c].dtype)}
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{(~same).sum()} values, first: {a.loc[at].to_dict()} / {b.loc[at].to_dict()} {kinds}"
    return f"types {kinds}" if kinds else None


def main(argv: list[str]) -> int:
    from quartergrid.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        t0 = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
        except Exception as e:  # report and go on with the next query
            print(f"{name}: ERROR {str(e)[:1500]}", flush=True)
            bad += 1
            continue
        t1 = time.time()
        if name not in ORACLE:
            print(f"{name}: {len(got)} rows, no SQL  spark {t1 - t0:.1f}s {got.head(3).to_dict('records')}", flush=True)
            continue
        try:
            diff = difference(got, con.execute(ORACLE[name]).df())
        except Exception as e:
            diff = f"ORACLE ERROR {str(e)[:800]}"
        bad += diff is not None
        print(f"{name}: {'ok' if diff is None else diff}  {len(got)} rows  "
              f"spark {t1 - t0:.1f}s sql {time.time() - t1:.1f}s", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
