"""Run every query against its SQL twin: python -m tests.check_all [sf_dir] [name ...]"""

import sys
import time

import __spark_entry__ as entry
from tests.conftest import build_session
from tests.oracle import connect, differences


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                verdict = differences(df, con, oracles[name]) or "ok"
            else:
                verdict = f"ok (no SQL), {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:400]}"
        bad += not verdict.startswith("ok")
        print(f"{name:34s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
