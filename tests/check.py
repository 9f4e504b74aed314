"""Run registered queries next to their SQL and compare: python tests/check.py [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


TIMES = {}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    left_cols, left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    TIMES["spark"] = time.time()
    cur = con.execute(sql)
    right_cols, right = rows_of([d[0] for d in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        only = [x for x in left if x not in set(right)][:2], [x for x in right if x not in set(left)][:2]
        return f"rows {len(left)} != {len(right)}: {str(only)[:600]}"
    diff = [(a, b) for a, b in zip(left, right) if a != b]
    if diff:
        return f"{len(diff)} of {len(left)} rows differ, e.g. {str(diff[0])[:800]}"
    return None if left else "no rows to compare"


def main() -> None:
    import __spark_entry__ as entry
    from newsloom.session import build_session

    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(cores=8)
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(queries)
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                spark_time = TIMES["spark"] - t
                note = f"{spark_time:6.1f}s ok" if problem is None else f"DIFF {problem}"
            else:
                problem, note = None, f"rows-only {df.count()}"
        except Exception as e:  # report and go on
            problem = note = f"ERROR {type(e).__name__} {str(e)[:900]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - t:6.1f}s {note}", flush=True)
    print("failed:", bad, "of", len(names))


if __name__ == "__main__":
    main()
