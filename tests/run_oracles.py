"""Run every registered query against its oracle at one scale factor.

    python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.session import open_session  # noqa: E402
from tests.oracle import compare, duck_connection  # noqa: E402

import __spark_entry__ as entry_mod  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = open_session(master="local[8]", extra={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    qs, oracles = entry_mod.queries(), entry_mod.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        if name not in oracles:
            n = q(spark, sf_dir).count()
            print(f"ROWS  {name:32s} rows={n} {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            problems, n = compare(spark, con, name, q, oracles[name], sf_dir)
        except Exception as e:  # report and go on
            problems, n = [f"error {type(e).__name__}: {str(e)[:300]}"], -1
        status = "OK   " if not problems else "FAIL "
        bad += bool(problems)
        print(f"{status} {name:32s} rows={n} {time.time() - t0:.1f}s {'; '.join(problems)}", flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
