"""Runs queries on Spark and DuckDB over one folder and compares names, types and rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences between a Spark query and its SQL; empty when they agree."""
    df = query(spark, sf_dir)
    got_names = df.columns
    got = _sorted_rows(got_names, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_names = [d[0] for d in res.description]
    want = _sorted_rows(want_names, res.fetchall())
    problems = []
    if sorted(got_names) != sorted(want_names):
        return [f"columns {sorted(got_names)} != {sorted(want_names)}"]
    kinds = dict(zip(want_names, (str(d[1]) for d in res.description)))
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    odd = [(g, w) for g, w in zip(got, want) if g != w]
    if odd:
        problems.append(f"{len(odd)} rows differ, first: {odd[0][0]} != {odd[0][1]}")
    return problems


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as failure:  # shown, and the run goes on
            problems = [f"{type(failure).__name__}: {str(failure)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, flush=True)
    print(f"{bad} of {len(names)} differ")
