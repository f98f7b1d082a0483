"""Compare every registered query with its SQL: ``python tests/check_all.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.compare import connect, spark_rows, sql_rows


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            columns, rows = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            if name not in oracle:
                print(f"ROWS {name}: {len(rows)} rows, {took:.1f}s")
                continue
            sql_columns, expected = sql_rows(con, oracle[name])
            if columns != sql_columns:
                verdict = f"COLUMNS {columns} / {sql_columns}"
            elif rows != expected:
                diff = [(a, b) for a, b in zip(rows, expected) if a != b]
                verdict = f"DIFF {len(rows)} / {len(expected)} first {diff[:1]}"
            else:
                verdict = "ok"
        except Exception as error:
            if os.environ.get("TRACE"):
                traceback.print_exc()
            rows, took = [], time.time() - start
            verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += verdict != "ok"
        print(f"{verdict[:1200]} {name}: {len(rows)} rows, {took:.1f}s", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
