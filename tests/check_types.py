"""Compare result column types, Spark vs DuckDB, for every query."""
import sys
sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")
from harness import duck
from jobledger.catalog import ORACLE, QUERIES
from jobledger.session import get_session

MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
       "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE"}
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = get_session()
con = duck(sf)
bad = 0
for n in sorted(ORACLE):
    sd = dict(QUERIES[n](spark, sf).dtypes)
    rel = con.sql(ORACLE[n])
    dd = dict(zip(rel.columns, [str(t) for t in rel.types]))
    diffs = [(c, sd[c], dd.get(c)) for c in sd if MAP.get(sd[c], sd[c]) != dd.get(c)]
    if diffs:
        bad += 1
        print(n, diffs)
print("queries with type differences:", bad)
