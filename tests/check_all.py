"""CLI: compare every registered query with its oracle.

    python tests/check_all.py [sf_dir] [name ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fathom.plans import ORACLES, QUERIES  # noqa: E402
from fathom.session import get_spark  # noqa: E402
from tests.oracle_compare import compare, duck_connect  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or sorted(QUERIES)
    spark = get_spark("local[8]")
    con = duck_connect(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        if n not in ORACLES:
            try:
                c = QUERIES[n](spark, sf_dir).count()
                print(f"ROWS  {n}: {c} rows ({time.time()-t:.1f}s)")
            except Exception as exc:  # report and continue
                bad += 1
                print(f"ERROR {n}: {type(exc).__name__}: {str(exc)[:400]}")
            continue
        try:
            ok, probs = compare(spark, n, QUERIES[n], ORACLES[n], sf_dir, con)
        except Exception as exc:
            ok, probs = False, [f"{type(exc).__name__}: {str(exc)[:600]}"]
        bad += not ok
        print(f"{'OK   ' if ok else 'FAIL '} {n} ({time.time()-t:.1f}s) {'' if ok else probs}")
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
