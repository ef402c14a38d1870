"""Compare queries with their SQL: ``python -m tests.compare [sf dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, values as text, sorted."""
    frame = frame[sorted(frame.columns)]

    def text(v) -> str:
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return "null"
        if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """Why two results differ, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} vs {len(sql_frame)}"
    a, b = normal(spark_frame), normal(sql_frame)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        begun = time.time()
        try:
            result = queries[name](spark, sf).toPandas()
            spent = time.time() - begun
            if name in oracles:
                why = difference(result, con.execute(oracles[name]).df())
            else:
                why = None if len(result) else "no rows"
        except Exception as error:  # report and go on with the next query
            spent, why = time.time() - begun, f"{type(error).__name__}: {str(error)[:700]}"
        bad += why is not None
        mark = "FAIL" if why else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name:28s} {spent:6.2f}s {len(result) if not why else ''} {why or ''}", flush=True)
    print(f"{bad} failures", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
