"""Compare all queries, or the named ones, with their SQL: python -m tests.check_all [sf] [name...]"""

from __future__ import annotations

import sys
import time

from lakewarden.plans import QUERIES, SQL
from lakewarden.session import build_session
from tests.oracle import compare, connect


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in SQL:
                problems = compare(spark, con, QUERIES[name], SQL[name], sf_dir)
            else:
                problems = [] if QUERIES[name](spark, sf_dir).count() else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(problems)
        mark = "sql " if name in SQL else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {mark} {time.time() - start:6.2f}s {name} {problems or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} good")
    return failed


if __name__ == "__main__":
    sys.exit(main())
