"""Run registered queries and their SQL side by side.

    python -m tidemart.checks.compare FOLDER [NAME ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize()) if value else "0")
    if isinstance(value, float):
        return ("float", round(value, 9))
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, function, sql: str, folder: str) -> str | None:
    """None when names, row count and values agree, otherwise what differs."""
    df = function(spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    theirs = _rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    if ours == theirs:
        return None if ours else "both results are empty"
    return (f"{sum(ours.values())} rows here, {sum(theirs.values())} there; only here "
            f"{list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}")


def main(folder: str, names: list[str]) -> int:
    from tidemart.checks.oracle import oracle_texts
    from tidemart.queries import QUERIES
    from tidemart.session import build_session

    spark = build_session("compare", {"spark.sql.shuffle.partitions": "8",
                                      "spark.driver.memory": "12g"},
                          master="local[8]", log_level="ERROR")
    con, texts, bad = connect(folder), oracle_texts(), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = (compare(spark, con, QUERIES[name], texts[name], folder)
                       if name in texts else "no SQL")
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s"
              + (f"\n     {problem}" if problem else ""), flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
