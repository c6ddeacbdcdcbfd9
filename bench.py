"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

The ERP tables are first derived from the driver tables and written once as
Parquet (timed separately as "adapter"), as a production source would be
stored; each query is then executed completely with the no-op sink (no
collect) and timed.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerflow import registry  # noqa: E402
from ledgerflow.session import build_session, scratch_path  # noqa: E402
from ledgerflow.sources.adapter import ErpTables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k]
    spark = build_session(f"local[{cpus}]", app="ledgerflow-bench", shuffle_partitions=4 * cpus, extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    })
    sf = sf_dir.rsplit("sf", 1)[-1]

    t0 = time.time()
    # the ERP tables go to the shared checkpoint folder named by the session
    stored = ErpTables(spark, sf_dir).materialize(scratch_path(spark, f"bench-erp-{uuid.uuid4().hex}"))
    adapter_sec = time.time() - t0
    registry.use_tables(spark, sf_dir, stored)

    # warm-up (JIT, class loading) outside the timed section
    stored.f_compteg.write.format("noop").mode("overwrite").save()

    qs = registry.queries()
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in sorted(qs):
        if only and name not in only:
            continue
        t1 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.time() - t1, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(timings.values()), 3)
    out = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": timings,
           "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus,
           "adapter_seconds": round(adapter_sec, 3), "n_queries": len(timings)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
