"""Compare registered queries with their SQL on DuckDB: python tests/oracle.py [sf_dir] [name ...]"""

import datetime
import decimal
import math
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def plain(v):
    if isinstance(v, decimal.Decimal) or isinstance(v, float):
        return None if isinstance(v, float) and math.isnan(v) else f"{float(v):.6g}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(str(plain(r[i])) for i in order) for r in data))


def compare(spark, sf_dir, query, sql):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads=2")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(sql)
    want = rows([c[0] for c in cur.description], cur.fetchall())
    df = query(spark, sf_dir)
    return rows(df.columns, [tuple(r) for r in df.collect()]), want


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[3]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    queries, sql = e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or [q for q in queries if q.startswith("q")]:
        try:
            if name not in sql:
                print(name, "rows", queries[name](spark, sf).count())
                continue
            got, want = compare(spark, sf, queries[name], sql[name])
            same = got == want
            print(name, "same" if same else "DIFFERENT", len(got[1]), len(want[1]))
            if not same:
                print("   ", got[0], want[0], [r for r in got[1] if r not in want[1]][:2], [r for r in want[1] if r not in got[1]][:2])
        except Exception as x:  # noqa: BLE001
            print(name, "FAILED", str(x)[:600])
