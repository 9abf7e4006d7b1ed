"""Run registered queries beside their SQL in DuckDB and compare whole results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[4]").appName("oracle-check")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, float):
            return repr(v)
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if hasattr(v, "item"):
            return text(v.item())
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in df.astype(object).itertuples(index=False, name=None))


def compare(spark, con, folder, name, build, sql) -> tuple[bool, str]:
    start = time.time()
    got = build(spark, folder)
    got_pd = got.toPandas()
    took = time.time() - start
    if sql is None:
        return True, f"rows={len(got_pd)} spark={took:.1f}s (no SQL)"
    start = time.time()
    relation = con.sql(sql)
    want_pd = relation.to_arrow_table().to_pandas()
    sql_took = time.time() - start
    note = f"rows={len(got_pd)}/{len(want_pd)} spark={took:.1f}s duck={sql_took:.1f}s"
    if sorted(got_pd.columns) != sorted(want_pd.columns):
        return False, f"{note} columns {sorted(got_pd.columns)} != {sorted(want_pd.columns)}"
    widths = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    spark_types = {f.name: widths.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in got.schema}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    odd = {c: (t, duck_types[c]) for c, t in spark_types.items() if t != duck_types[c]}
    if odd:
        return False, f"{note} types {odd}"
    a, b = normal(got_pd), normal(want_pd)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a = [r for r in a if r not in in_b]
        only_b = [r for r in b if r not in in_a]
        note += f" differ {len(only_a)}/{len(only_b)}"
        only_a, only_b = only_a[:3], only_b[:3]
        return False, f"{note} {sorted(got_pd.columns)}\n   spark only {only_a}\n   sql only   {only_b}"
    return True, note


def main() -> int:
    import __spark_entry__ as entry_module

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = session()
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    bad = []
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        try:
            ok, note = compare(spark, con, folder, name, build, oracles.get(name))
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(("ok   " if ok else "FAIL ") + name, note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
