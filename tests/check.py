"""Run catalogue queries against DuckDB: ``python tests/check.py [sf] [name part ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.session import builder  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, differences  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    parts = sys.argv[2:]
    d = f"/root/testdata/{sf}"
    spark = (
        builder().master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(d)
    sqls = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            if name in sqls:
                diff = differences(spark, con, run, sqls[name], d)
            else:
                n = run(spark, d).count()
                diff = f"rows only: {n}" if n else "empty"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:400]}"
        ok = diff is None or diff.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - t:6.2f}s {diff or ''}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main() != 0)
