"""Compare every Spark query with its DuckDB SQL: rows, columns, values."""
import sys, time, decimal, datetime, math
sys.path.insert(0, "/root/repo")
import duckdb
import importlib
entry = importlib.import_module("__spark_entry__")
from ordermart.session import local_session

SF_SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

def norm(v):
    if v is None: return None
    if isinstance(v, float):
        if math.isnan(v): return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal): return str(v.normalize()) if v == v else "nan"
    if isinstance(v, datetime.datetime): return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date): return v.isoformat()
    return v

def key(r): return tuple((x is None, str(x)) for x in r)

def main(sf, names):
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = entry.queries(), entry.oracle_sql()
    ok = 0
    for name in names or qs:
        t = time.time()
        df = qs[name](spark, sf)
        cols = sorted(df.columns)
        srows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
        ts = time.time() - t
        if name not in sql:
            print(f"{name:28s} spark-only rows={len(srows)} {ts:.1f}s"); continue
        rel = con.sql(sql[name])
        dcols = rel.columns
        drows_raw = rel.fetchall()
        if sorted(dcols) != cols:
            print(f"{name:28s} COLUMNS DIFFER spark={cols} duck={sorted(dcols)}"); continue
        idx = [dcols.index(c) for c in cols]
        drows = sorted((tuple(norm(r[i]) for i in idx) for r in drows_raw), key=key)
        same = srows == drows
        ok += same
        print(f"{name:28s} {'OK  ' if same else 'DIFF'} spark={len(srows)} duck={len(drows)} {ts:.1f}s", flush=True)
        if not same:
            sset, dset = set(srows), set(drows)
            print("   spark-only:", list(sset - dset)[:3]); print("   duck-only:", list(dset - sset)[:3])
    print("matched", ok)

if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
