"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import make_session  # noqa: E402
from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(E.queries())
spark = make_session()
con = duck(sf)
sqls = E.oracle_sql()
bad = 0
for n in names:
    t0 = time.time()
    try:
        df = E.queries()[n](spark, sf)
        probs = compare(df, con, sqls[n]) if n in sqls else ["no oracle"]
    except Exception as e:  # report and continue
        probs = [f"ERROR {type(e).__name__}: {str(e)[:400]}"]
    bad += bool(probs)
    print(f"{'OK ' if not probs else 'BAD'} {n:30s} {time.time()-t0:6.2f}s {'; '.join(probs)}", flush=True)
print("failures:", bad)
