"""Run registered queries beside their SQL twins and compare.

``python -m tests.oracle [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from evidenza.plans.catalog import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _kind(type_name: str) -> str:
    name = type_name.upper()
    return {"VARCHAR": "STRING", "INTEGER": "INT"}.get(name, name)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, folder: str, build, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    df = build(spark, folder)
    left = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    right = {d[0]: _kind(str(d[1])) for d in result.description}
    want = _table([d[0] for d in result.description], result.fetchall())
    if left != right:
        return f"schema {left} != {right}"
    if len(got) != len(want):
        only_got = set(map(repr, got)) - set(map(repr, want))
        only_want = set(map(repr, want)) - set(map(repr, got))
        return f"{len(got)} rows != {len(want)}; e.g. {list(only_got)[:2]} / {list(only_want)[:2]}"
    wrong = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ; {sorted(left)} {wrong[0]}" if wrong else None


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> None:
    import __spark_entry__ as entry
    from evidenza.session import build_session

    spark = build_session(
        master="local[8]", shuffle_partitions=8,
        **{"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(folder), entry.oracle_sql()
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                found = difference(spark, con, folder, build, oracles[name])
            else:
                found = f"no oracle, {build(spark, folder).count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.2f}s  {found or 'equal'}"[:2500], flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
