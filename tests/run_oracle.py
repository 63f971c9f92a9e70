"""Compare queries with their oracle SQL: run_oracle.py SF_DIR [NAME ...]."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

sf_dir, names = sys.argv[1], sys.argv[2:]
spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
db, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
for name, build in entry.queries().items():
    if names and name not in names:
        continue
    start = time.time()
    try:
        count, problems = compare(build(spark, sf_dir), db, sql[name])
    except Exception as error:
        count, problems = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
    bad += bool(problems)
    print(f"{'FAIL' if problems else 'ok  '} {name:28} {count:7} rows {time.time() - start:6.2f}s", flush=True)
    for problem in problems:
        print("     ", problem)
print("failed:", bad)
