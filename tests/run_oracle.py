"""CLI: compare every registered query with its oracle. Usage: python -m tests.run_oracle [sf_dir] [names...]"""

import json
import sys
import time

sys.path.insert(0, ".")

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402
from workpulse.session import get_spark  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(queries())
spark = get_spark(master="local[8]", shuffle_partitions=8)
con = duck(sf_dir)
bad = 0
for name in names:
    sql = oracle_sql().get(name)
    t = time.time()
    if sql is None:
        n = queries()[name](spark, sf_dir).count()
        print(name, json.dumps({"rows_only": n, "sec": round(time.time() - t, 2)}))
        continue
    try:
        res = compare(spark, queries()[name], sql, sf_dir, con)
    except Exception as e:  # noqa: BLE001
        res = {"error": repr(e)[:2000]}
    ok = res.get("values_match") and res.get("types_match") and res.get("spark_rows") == res.get("oracle_rows")
    bad += not ok
    res["sec"] = round(time.time() - t, 2)
    print(("OK  " if ok else "BAD ") + name, json.dumps(res, default=str))
print("failures:", bad)
