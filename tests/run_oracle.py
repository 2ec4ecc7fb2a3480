"""CLI: python tests/run_oracle.py [sf_dir] [name ...] — prints one line per query."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from harness import compare, duck  # noqa: E402
from earshot.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session("local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for n, fn in qs.items():
    if names and n not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if n in sqls:
            r = compare(spark, con, n, df, sqls[n])
        else:
            r = {"name": n, "rows_only": df.count(), "ok": True}
    except Exception as e:  # report and continue
        r = {"name": n, "ok": False, "error": str(e)[:600]}
    r["sec"] = round(time.time() - t, 2)
    bad += not r["ok"]
    print(r, flush=True)
print("FAILED" if bad else "ALL OK", bad)
