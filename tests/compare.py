"""Compare every registered query with its SQL on another engine, over whole tables."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int):
        return float(f"{value:.15g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def sql_rows(folder: str, sql: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def difference(spark, folder: str, query, sql: str) -> str | None:
    """None if both give the same columns and the same bag of rows."""
    df = query(spark, folder)
    names, rows = sql_rows(folder, sql)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(df.columns)
    ours = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    at = [names.index(c) for c in order]
    theirs = Counter(tuple(_plain(row[i]) for i in at) for row in rows)
    if ours == theirs:
        return None
    more, less = ours - theirs, theirs - ours
    return f"{sum(more.values())} rows only here, {sum(less.values())} only there: {order} {list(more)[:2]} {list(less)[:2]}"


def main() -> None:
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = difference(spark, folder, query, sql[name]) if name in sql else f"{query(spark, folder).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - a report over all queries
            found = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}"[:1200], flush=True)


if __name__ == "__main__":
    main()
