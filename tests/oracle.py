"""Compares registered queries with their SQL in DuckDB, value by value."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"f{v:.9g}"
    if isinstance(v, int):
        return f"i{v}"
    return str(v)


SAME_TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER",
}


def type_differences(spark_df, con, sql: str) -> list[str]:
    """Columns whose types are not the same on both sides."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{n}: {t} / {want.get(n)}" for n, t in spark_df.dtypes if SAME_TYPES.get(t) != want.get(n)
    ]


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != sorted(spark_df.columns):
        return f"columns: spark {sorted(spark_df.columns)}, sql {sorted(cols)}"
    names = sorted(cols)
    want = sorted(
        tuple(_cell(r[cols.index(n)]) for n in names) for r in cur.fetchall()
    )
    pos = [spark_df.columns.index(n) for n in names]
    got = sorted(tuple(_cell(r[i]) for i in pos) for r in spark_df.collect())
    if got == want:
        return None
    in_want, in_got = set(want), set(got)
    only_got = [r for r in got if r not in in_want][:3]
    only_want = [r for r in want if r not in in_got][:3]
    return f"{names}\n rows: spark {len(got)}, sql {len(want)}\n spark only {only_got}\n sql only {only_want}"


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from rillmark.session import local_session

    spark = local_session()
    con = connect(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.monotonic()
        try:
            if name in oracle:
                found = difference(run(spark, sf_dir), con, oracle[name])
            else:
                found = None if run(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        took = time.monotonic() - began
        print(f"{'ok  ' if found is None else 'BAD '} {name} {took:.2f}s {found or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
