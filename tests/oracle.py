"""Compare a query with its SQL on the same parquet files."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


_KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def compare(df, sql: str, con, exact_types: bool = True) -> str | None:
    """None if equal, else what differs."""
    rel = con.sql(sql)
    names = sorted(rel.columns)
    if names != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {names}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    if exact_types:
        for f in df.schema:
            want = _KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
            if kinds[f.name] != want:
                return f"type of {f.name}: {want} != {kinds[f.name]}"
    got = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_key)
    order = ", ".join(f'"{n}"' for n in names)
    want = sorted((tuple(map(_plain, r)) for r in con.sql(f"SELECT {order} FROM ({sql})").fetchall()), key=_key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[:2]}" if bad else None


def main() -> None:
    import sys

    import __spark_entry__ as entry
    from foldwright.session import local_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in chosen or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                told = compare(df, oracles[name], con) or "ok"
            else:
                told = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            told = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{time.time() - start:6.2f}s {name}: {told}", flush=True)


if __name__ == "__main__":
    main()
