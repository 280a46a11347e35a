"""Run registered queries on Spark and their SQL on DuckDB, and compare all rows.

``python -m tests.compare [--sf 0.1] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when schema and rows agree, else the first difference."""
    answer = con.execute(sql)
    want_columns = [d[0] for d in answer.description]
    want_types = {d[0]: str(d[1]) for d in answer.description}
    want = rows_of(want_columns, answer.fetchall())
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    for name, kind in df.dtypes:
        if TYPES.get(kind) != want_types[name]:
            return f"type of {name}: {kind} != {want_types[name]}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        return f"{len(differing)} of {len(got)} rows differ, e.g. {differing[0]}"
    return None if got else "no rows"


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> int:
    import __spark_entry__ as entry
    from tidemark import build_session

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failures = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - began:.2f}s {'' if name in sqls else '(no sql)'} {problem or ''}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    directory = "/root/testdata/sf0.01"
    if sys.argv[1:2] == ["--sf"]:
        directory, sys.argv[1:3] = f"/root/testdata/sf{sys.argv[2]}", []
    sys.exit(1 if main(sys.argv[1:], directory) else 0)
