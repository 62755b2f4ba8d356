"""Manual runner: python tests/run_oracles.py [sf_dir] [name ...]"""

import sys
import time

sys.path.insert(0, "tests"); sys.path.insert(0, ".")
from oracle_compare import compare, duck  # noqa: E402

from tidepool.plans.catalog import ORACLE, QUERIES  # noqa: E402
from tidepool.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or sorted(QUERIES)
spark = build_session("local[8]", 8)
con = duck(sf)
bad = 0
for n in names:
    t0 = time.time()
    if n not in ORACLE:
        c = QUERIES[n](spark, sf).count()
        print(f"{n:32s} ROWS-ONLY {c} rows {time.time()-t0:.1f}s", flush=True)
        continue
    try:
        ok, msg = compare(spark, con, n, QUERIES[n], ORACLE[n], sf)
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
    bad += not ok
    print(f"{n:32s} {'OK ' if ok else 'BAD'} {msg} {time.time()-t0:.1f}s", flush=True)
print("failures:", bad)
