"""Compare registered queries with their SQL: column names and types, row counts, exact values as multisets."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weirflow.plans.queries import ORACLES, QUERIES  # noqa: E402

NO_ROWS = "no rows"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    theirs_columns = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} != {sorted(theirs_columns)}"
    a = [df.columns.index(c) for c in sorted(df.columns)]
    b = [theirs_columns.index(c) for c in sorted(theirs_columns)]
    left = Counter(tuple(_plain(r[i]) for i in a) for r in mine)
    right = Counter(tuple(_plain(r[i]) for i in b) for r in theirs)
    if left != right:
        only_l, only_r = left - right, right - left
        return f"{len(mine)} rows against {len(theirs)}; {sorted(df.columns)}\n   only mine: {list(only_l)[:3]}\n   only sql:  {list(only_r)[:3]}"
    types_l = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    types_r = {d[0]: str(d[1]) for d in cur.description} if cur.description else {}
    for c in types_l:
        if (types_l[c] in ("int", "bigint", "double", "boolean", "string")) and not _same_type(types_l[c], types_r.get(c, "")):
            return f"type of {c}: {types_l[c]} against {types_r.get(c)}"
    return None if mine else NO_ROWS


def _same_type(a: str, b: str) -> bool:
    return {"int": ("INTEGER",), "bigint": ("BIGINT",), "double": ("DOUBLE",), "boolean": ("BOOLEAN",), "string": ("VARCHAR", "JSON")}[a].__contains__(b)


if __name__ == "__main__":
    from weirflow.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            if name in ORACLES:
                result = compare(spark, con, name, sf_dir)
            else:
                result = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.1f}s" + (f" {result}" if result else ""), flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")
