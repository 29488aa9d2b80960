"""Side-by-side run of queries in Spark and their oracles in DuckDB.

``python -m tests.compare [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

from emiscope.plans.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(tuple(_plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], lines


_KINDS = {
    "HUGEINT": "bigint", "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "UBIGINT": "ubigint", "JSON": "string",
}


def difference(df, con, sql) -> str | None:
    """None when both sides hold the same rows under the same column names."""
    found = con.execute(sql)
    want_cols, want = _table([d[0] for d in found.description], found.fetchall())
    have_cols, have = _table(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != have_cols:
        return f"columns {have_cols} against {want_cols}"
    types = dict(df.dtypes)
    for name, kind in ((d[0], str(d[1])) for d in found.description):
        kind = _KINDS.get(kind, kind.lower().replace(" ", ""))
        if kind != types[name] and '"null"' not in kind:
            return f"type of {name}: {types[name]} against {kind}"
    if len(want) != len(have):
        return f"{len(have)} rows against {len(want)}"
    bad = [(h, w) for h, w in zip(have, want) if h != w]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0][0]} against {bad[0][1]}"
    return None


def main() -> None:
    from emiscope.plans.catalog import ORACLES, QUERIES
    from emiscope.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                note = difference(df, con, ORACLES[name]) or "ok"
            else:
                note = f"ok, {df.count()} rows, no oracle"
        except Exception as error:  # report and go on with the next query
            note = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not note.startswith("ok")
        print(f"{time.time() - started:6.2f}s {name}: {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    os.environ.setdefault("PYTHONPATH", os.getcwd())
    main()
