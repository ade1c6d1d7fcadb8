"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(canonical(v) for v in value)
    return value


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


SPARK_SECONDS: dict[str, float] = {}
KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE"}


def compare(spark, con, name, fn, sql, sf_dir):
    """Return a list of differences (empty when equal)."""
    start = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    SPARK_SECONDS[name] = time.time() - start
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = table_rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return [f"columns differ: {sorted(set(got_cols) ^ set(want_cols))}"]
    problems = []
    for c, t in df.dtypes:
        if KIND.get(t) and kinds[c] not in (KIND[t], "NUMBER"):
            problems.append(f"type of {c}: {t} vs {kinds[c]}")
    if len(got) != len(want):
        problems.append(f"rows: {len(got)} vs {len(want)}")
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    for g, w in diff[:3]:
        cells = [(got_cols[i], a, b) for i, (a, b) in enumerate(zip(g, w)) if a != b]
        problems.append(f"row differs: {cells[:6]}")
    if diff:
        problems.append(f"{len(diff)} of {len(want)} rows differ")
    return problems


def force_split(spark, on: bool = True):
    """Make every group count as hot, so that the split forms run on small data."""
    settings = {"smallInputBytes": 0, "rowsPerTask": 5, "sliceBytes": 20_000, "broadcastBytes": 0}
    for key, value in settings.items():
        if on:
            spark.conf.set(f"spark.loomline.{key}", str(value))
        else:
            spark.conf.unset(f"spark.loomline.{key}")


def main() -> int:
    from loomline.plans.oracles import SQL
    from loomline.plans.queries import QUERIES
    from loomline.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    if os.environ.get("PLAIN_SESSION"):  # a session without any of our settings
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session()
    con, bad = connect(sf_dir), 0
    if os.environ.get("FORCE_SPLIT"):
        force_split(spark)
    for name in names:
        start = time.time()
        try:
            if name in SQL:
                problems = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
                note = "ok"
            else:
                note = f"no sql, {QUERIES[name](spark, sf_dir).count()} rows"
                problems = []
        except Exception as e:
            problems, note = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        bad += bool(problems)
        print(f"{name:32s} {SPARK_SECONDS.get(name, 0):6.2f}s of {time.time() - start:6.2f}s  {'; '.join(problems) or note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
