"""Run every query against its SQL and print what differs: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path[:0] = [".", "tests"]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from stratiform.session import build  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    if os.environ.get("PLAIN_SESSION"):  # as someone else's session would be
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems = compare(run(spark, sf_dir), con, oracles[name]) if name in oracles else ["no sql"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{name:40s} {time.time() - start:6.2f}s {'ok' if not problems else problems}", flush=True)
    print("bad:", bad)
