"""Run registered queries next to their SQL in DuckDB and compare rows.

    python tests/compare.py [data folder] [query ...]
"""

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(rows, columns):
    """Rows as (exact cells, float cells) in column-name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for r in rows:
        cells = [r[i] for i in order]
        floats = tuple(v for v in cells if isinstance(v, float))
        out.append((tuple("#" if isinstance(v, float) else str(v) for v in cells), floats))
    return sorted(out, key=lambda r: (r[0], tuple(round(v, 5) for v in r[1])))


def same(a, b, tolerance):
    return a[0] == b[0] and all(abs(x - y) <= tolerance or x == y or (x != x and y != y) for x, y in zip(a[1], b[1]))


def compare(spark, con, name, query, sql, folder, tolerance=0.0):
    """None when equal, else a short description."""
    df = query(spark, folder)
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    theirs = canonical(res.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if not same(a, b, tolerance)]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, queries, sql = connect(folder), e.queries(), e.oracle_sql()
    print("sql without query:", sorted(set(sql) - set(queries)), "no sql:", sorted(set(queries) - set(sql)))
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            if name not in sql:
                print("rows", queries[name](spark, folder).count(), end=" ")
                problem = None
                raise StopIteration
            problem = compare(spark, con, name, queries[name], sql[name], folder)
        except StopIteration:
            pass
        except Exception as x:
            problem = f"{type(x).__name__} {str(x)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
