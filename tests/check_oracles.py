"""CLI: run registered queries against their DuckDB oracles and print a summary.

    python tests/check_oracles.py [sf_dir] [query-id-substring ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from oracle import compare, duck, exact_hash_equal  # noqa: E402

from riskline.plans.catalog import load  # noqa: E402
from riskline.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = local_session("*", 8)
    con = duck(sf)
    reg = load()
    bad = 0
    for qid, q in reg.items():
        if pats and not any(p in qid for p in pats):
            continue
        t0 = time.time()
        try:
            got = q.fn(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL-SPARK {qid}: {e!r}"[:600])
            traceback.print_exc(limit=3)
            continue
        dt = time.time() - t0
        if q.sql is None:
            print(f"ROWS {qid}: {len(got)} rows {dt:.2f}s")
            continue
        try:
            exp = con.sql(q.sql).df()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL-SQL {qid}: {e!r}"[:600])
            continue
        ok, why = compare(got, exp)
        exact = exact_hash_equal(got, exp) if ok else False
        if not ok:
            bad += 1
        print(f"{'OK  ' if ok else 'DIFF'} {qid}: {len(got)} rows {dt:.2f}s exact={exact} {'' if ok else why}"[:900])
    print(f"{bad} problems")
    spark.stop()


if __name__ == "__main__":
    main()
