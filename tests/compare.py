"""Run registered queries next to their SQL twins and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(d: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if v != v.to_integral_value() else repr(float(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(0.0 if v == 0 else v)
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "asDict"):
        return tuple((k, plain(x)) for k, x in sorted(v.asDict().items()))
    return v


def type_family(t: str) -> str:
    t = t.upper()
    return {"BIGINT": "BIGINT", "LONG": "BIGINT", "INTEGER": "INT", "INT": "INT", "VARCHAR": "STRING", "STRING": "STRING"}.get(t, t)


def compare(spark, con, d, name, fn, sql):
    """None when equal, else what differs."""
    df = fn(spark, d)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    types = {x[0]: str(x[1]) for x in rel.description}
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    idx = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in idx) for r in rel.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    g, w = sorted(got, key=repr), sorted(want, key=repr)
    if g != w:
        only_g = sorted(set(map(repr, g)) - set(map(repr, w)))[:2]
        only_w = sorted(set(map(repr, w)) - set(map(repr, g)))[:2]
        return f"values differ in {sum(a != b for a, b in zip(g, w))} of {len(g)}: {str(only_g)[:700]} vs {str(only_w)[:700]}"
    odd = []
    for f in df.schema:
        s, q = type_family(f.dataType.simpleString()), type_family(types[f.name])
        if s != q and not ("ARRAY" in s or "STRUCT" in s or "TIMESTAMP" in s):
            odd.append(f"{f.name}: {s} vs {q}")
    if odd:
        return f"types {odd}"
    return None if got else "no rows"


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from rankloom.session import build_session

    d = os.environ.get("COMPARE_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(d)
    qs, oracles = entry.queries(), entry.oracle_sql()
    wanted = [q for q in qs if not argv or any(q.startswith(a) for a in argv)]
    bad = 0
    for name in wanted:
        t = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, d, name, qs[name], oracles[name])
            else:
                n = qs[name](spark, d).count()
                problem = None if n else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {time.time() - t:6.2f}s {'' if name in oracles else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
