"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(value + 0.0)
    if isinstance(value, (int, bool)):
        return repr(float(value))
    return value


def spark_rows(frame) -> tuple[list[str], Counter]:
    columns = sorted(frame.columns)
    return columns, Counter(tuple(_plain(v) for v in row) for row in frame.select(*columns).collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty if the rows agree; otherwise a few of the rows that do not."""
    start = time.time()
    columns, ours = spark_rows(query(spark, sf_dir))
    middle = time.time()
    names, theirs = sql_rows(con, sql)
    print(f"  spark {middle - start:.1f}s, sql {time.time() - middle:.1f}s", flush=True)
    if columns != names:
        return f"columns {columns} against {names}"
    if ours == theirs:
        return ""
    left, right = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(left.values())} only ours, "
        f"{sum(right.values())} only theirs\n  {columns}\n  ours   {sorted(left, key=str)[:4]}\n"
        f"  theirs {sorted(right, key=str)[:4]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                found = difference(spark, con, query, oracle[name], sf_dir)
            else:
                found = f"no SQL, {query(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{name}: {'ok' if not found else found} [{time.time() - start:.1f}s]", flush=True)


if __name__ == "__main__":
    main()
