"""Run registered queries and their SQL side by side.

    python tests/compare.py [folder] [query ...]
"""

import datetime
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewmill.queries import ORACLES, QUERIES  # noqa: E402

TYPES = {"string": "VARCHAR", "boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def difference(spark, con, name, folder):
    """None when rows, columns and types agree, else a short text."""
    df = QUERIES[name](spark, folder)
    order = sorted(df.columns)
    rows = Counter(tuple(_value(r[c]) for c in order) for r in df.collect())
    if name not in ORACLES:
        return None if rows else "no rows"
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != order:
        return f"columns {order} / {sorted(names)}"
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    duck_types = {d[0]: str(d[1]) for d in result.description}
    at = [names.index(c) for c in order]
    want = Counter(tuple(_value(r[i]) for i in at) for r in result.fetchall())
    if rows != want:
        extra, missing = list((rows - want))[:2], list((want - rows))[:2]
        return f"rows {sum(rows.values())} / {sum(want.values())}; only Spark: {str(extra)[:600]}; only SQL: {str(missing)[:600]}"
    wrong = {c: (spark_types[c], duck_types[c]) for c in order if spark_types[c] != duck_types[c]}
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    from reviewmill.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{time.time() - start:6.1f}s {'ok  ' if problem is None else 'FAIL'} {name}{'' if name in ORACLES else ' (rows only)'} {problem or ''}", flush=True)
    print(f"{failed} failed of {len(sys.argv[2:] or QUERIES)}")
