"""Run registered queries against their DuckDB oracle: python tests/run_oracle.py [sf] [key ...]"""
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")
from oracle_harness import compare, duck_connect  # noqa: E402

from ledgerflow.registry import oracle_sql, queries  # noqa: E402
from ledgerflow.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
keys = sys.argv[2:]
sf_dir = f"/root/testdata/sf{sf}"
import os
spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.sql.session.timeZone": os.environ.get("SESSION_TZ", "UTC")})
con = duck_connect(sf_dir)
qs, os_ = queries(), oracle_sql()
bad = 0
for k in keys or sorted(qs):
    t0 = time.time()
    try:
        df = qs[k](spark, sf_dir)
        if k in os_:
            ok, msg = compare(df, os_[k], con)
        else:
            ok, msg = True, f"rows-only {df.count()}"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {k:32s} {time.time() - t0:6.1f}s {msg}", flush=True)
print("failures:", bad)
