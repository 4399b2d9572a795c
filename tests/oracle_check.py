"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does.

usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):  # Decimal
        return repr(round(float(v), 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_types(df):
    out = {}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t.startswith("decimal"):
            t = t.upper().replace("DECIMAL", "DECIMAL")
        out[f.name] = SPARK_TO_DUCK.get(t, t.upper())
    return out


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = df.collect()
        cols = df.columns
        t1 = time.time()
        entry = {"rows": len(rows), "sec": round(t1 - t0, 2)}
        if name in sqls:
            rel = con.sql(sqls[name])
            otypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            st = spark_types(df)
            type_diff = {c: (st.get(c), otypes.get(c)) for c in set(st) | set(otypes) if st.get(c) != otypes.get(c)}
            if type_diff:
                entry["type_diff"] = type_diff
            entry.update(oracle_rows=len(orows), cols_match=sorted(cols) == sorted(ocols),
                         hash_match=digest(cols, rows) == digest(ocols, orows))
            if sorted(cols) != sorted(ocols):
                entry["cols"] = (cols, ocols)
        results[name] = entry
        if verbose:
            print(name, entry, flush=True)
    return results


if __name__ == "__main__":
    from glossa.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if "hash_match" in v and not (v["hash_match"] and v["cols_match"])]
    print("MISMATCH:", bad)
