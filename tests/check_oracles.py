"""Run every registered query against its oracle: python tests/check_oracles.py [sf_dir] [name...]"""

import sys
import time

sys.path.insert(0, "/root/repo")

from harness import compare, duck  # noqa: E402

from jobledger.catalog import ORACLE, QUERIES  # noqa: E402
from jobledger.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or sorted(QUERIES)
spark = get_session()
con = duck(sf)
bad = 0
for n in names:
    t = time.time()
    try:
        df = QUERIES[n](spark, sf)
        if n in ORACLE:
            probs, cnt = compare(df, con, ORACLE[n])
        else:
            cnt, probs = df.count(), ["(rows-only)"]
    except Exception as e:  # noqa: BLE001
        probs, cnt = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], -1
    ok = not probs or probs == ["(rows-only)"]
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:32s} rows={cnt:<7d} {time.time()-t:5.1f}s {' | '.join(probs)}", flush=True)
print(f"{len(names)-bad}/{len(names)} ok")
