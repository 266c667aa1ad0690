"""Run registered queries next to their SQL: ``python tests/compare.py <folder> [query ...]``."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def expected(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; values keep their types."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows), key=lambda r: repr(r)
    )


def difference(spark, folder: str, name: str) -> str | None:
    """None if the query and its SQL agree in column names, types and every row."""
    df = queries()[name](spark, folder)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    columns, rows = expected(folder, oracle_sql()[name])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = normal(columns, rows)
    if got == want:
        return None
    pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"rows {len(got)} != {len(want)}, first differences {pairs}"


if __name__ == "__main__":
    from lakestar.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("OFF")
    chosen = sys.argv[2:] or list(queries())
    wrong = 0
    for each in chosen:
        began = time.time()
        try:
            found = difference(session, sys.argv[1], each) if each in oracle_sql() else "no SQL"
        except Exception as problem:  # keep going: the other queries still say something
            found = f"{type(problem).__name__}: {str(problem)[:800]}"
        wrong += found is not None
        print(f"{each:32s} {time.time() - began:6.2f}s {found or 'ok'}", flush=True)
    sys.exit(1 if wrong else 0)
