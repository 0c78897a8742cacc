"""Run queries next to their SQL and compare the rows.

    python tests/oracle.py [sf] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return repr(round(value, 9))
    return f"{type(value).__name__}:{value}" if isinstance(value, bool) else str(value)


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows under the same names and kinds of types."""
    df = query(spark, sf_dir)
    relation = con.sql(sql)
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
             "TIMESTAMP": "timestamp_ntz", "DATE": "date"}
    want_types = {c: kinds.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    got_types = dict(df.dtypes)
    if got_types != want_types:
        return f"types: got {got_types}, want {want_types}"
    got = rows([tuple(r) for r in df.collect()], df.columns)
    want = rows(relation.fetchall(), relation.columns)
    if got != want:
        extra, missing = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows, want {len(want)}; extra {extra}; missing {missing}"
    return None if got else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.fallback", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clicklake-"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        if name not in oracles:
            print(f"{name:24} no SQL, {queries[name](spark, sf_dir).count()} rows")
            continue
        try:
            problem = compare(spark, con, queries[name], oracles[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{name:24} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or queries)} differ")


if __name__ == "__main__":
    main()
