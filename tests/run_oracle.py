"""Run every registered query against its oracle: ``python tests/run_oracle.py [sf_dir] [names...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in q.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in o:
                ok, msg = compare(df, con, o[name])
            else:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows"
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.1f}s  {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
