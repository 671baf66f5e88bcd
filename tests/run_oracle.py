"""Command line: python tests/run_oracle.py <sf_dir> [query ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_compare import connect, difference
from pyspark.sql import SparkSession

import __spark_entry__ as E


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or queries:
        begun = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                found = difference(df, con, oracle[name])
            else:
                found = None if df.count() > 0 else "no rows"
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - begun:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")


if __name__ == "__main__":
    main()
