"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return str([cell(x) for x in v])
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def compare(spark, con, name, run, sql, sf_dir):
    """Empty string when equal, else what differs."""
    start = time.time()
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    spark.catalog.clearCache()
    if sql is None:
        return took, len(rows), ""
    start = time.time()
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    kinds = {c[0]: KINDS.get(str(c[1]), str(c[1])) for c in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(cols):
        return took, len(rows), f"columns {sorted(set(df.columns) ^ set(cols))}"
    a, b = normal(df.columns, rows), normal(cols, want)
    problem = ""
    if len(a) != len(b):
        problem = f"rows {len(a)} vs {len(b)}"
    elif a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        names = sorted(cols)
        which = sorted({names[i] for x, y in bad for i in range(len(names)) if x[i] != y[i]})
        problem = f"{len(bad)}/{len(a)} rows differ in {which}: {bad[0]}"
    types = {c: (t, kinds[c]) for c, t in df.dtypes if t != kinds[c]}
    if types:
        problem += f" types {types}"
    return took, len(rows), problem


def session(cpus=8):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            took, n, problem = compare(spark, con, name, run, sqls.get(name), sf_dir)
        except Exception as error:
            took, n, problem = 0.0, 0, f"ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:40s} {took:6.2f}s {n:7d} {'' if name in sqls else '(rows only)'} {problem[:1800]}", flush=True)
    print("failures:", bad)
