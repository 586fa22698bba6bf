"""Compare registered queries with their SQL on DuckDB; also a command line tool.

    python tests/compare.py /root/testdata/sf0.001 [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(r[i]) for i in order) for r in data)


def differences(spark, con, sf_dir: str, query, sql: str | None):
    """None when equal, else a text; also the number of rows."""
    frame = query(spark, sf_dir)
    got = rows(frame.columns, frame.collect())
    if sql is None:
        return None, sum(got.values())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} but SQL {sorted(names)}", sum(got.values())
    want = rows(names, result.fetchall())
    if got == want:
        return None, sum(got.values())
    more, less = got - want, want - got
    sample = lambda c: [str(r)[:400] for r in list(c)[:2]]
    return (
        f"rows {sum(got.values())}/{sum(want.values())}; only Spark {sum(more.values())}: "
        f"{sample(more)}; only SQL {sum(less.values())}: {sample(less)}"
    ), sum(got.values())


def main() -> int:
    import __spark_entry__ as entry
    from papyra.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con, bad = local_session(8), duck(sf_dir), []
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in wanted or queries:
        start = time.time()
        try:
            problem, n = differences(spark, con, sf_dir, queries[name], sql.get(name))
        except Exception as error:  # keep going, report all
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
            if "-v" in sys.argv:
                traceback.print_exc()
        note = "" if name in sql else " (no SQL)"
        print(f"{'ok ' if not problem else 'BAD'} {name}{note} {n} rows {time.time() - start:.1f}s", flush=True)
        if problem:
            bad.append(name)
            print("    ", problem[:1500], flush=True)
    print(f"{len(bad)} of {len(wanted or queries)} differ: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())
