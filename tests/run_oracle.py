"""CLI: compare every binding (or the named ones) with its oracle.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare  # noqa: E402
from rollsnap.session import local_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session()
    qs, orc = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        if name not in orc:
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS {name}: {n} rows ({time.time() - t:.1f}s)")
            continue
        try:
            ok, msg = compare(spark, qs[name], orc[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg} ({time.time() - t:.1f}s)", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
