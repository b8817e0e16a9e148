"""Run registered queries in Spark and their SQL in DuckDB, and compare all rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from checks.oracles import all_sql
from checks.queries import all_queries
from voxloom.plans.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with each Parquet file of the folder as a view."""
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def difference(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> str | None:
    """What differs between the two results, or None."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    want = Counter(found.fetchall())
    got = Counter(tuple(row) for row in df.select(*names).toLocalIterator())
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (
        f"{got.total()} / {want.total()} rows; only in Spark {list(extra)[:2]!r:.700}; "
        f"only in SQL {list(missing)[:2]!r:.700}"
    )


def main(sf_dir: str, *only: str) -> int:
    spark = local_session("compare")
    con, sql, failures = connect(sf_dir), all_sql(), 0
    for name, query in all_queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            problem = difference(con, sql[name], query(spark, sf_dir))
        except Exception as e:  # report and go on with the other queries
            problem = f"{type(e).__name__}: {e!s:.1500}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - began:.1f}s", problem or "", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
