"""Runs a query and its SQL on the same tables and compares the rows."""

import datetime
import decimal
import glob
import math
import os


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def difference(spark, con, sf_dir, query, sql):
    """None if the rows are the same, else what differs."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        only = [x for x in got if x not in set(want)][:3], [x for x in want if x not in set(got)][:3]
        return f"{len(got)} and {len(want)} rows; only here {only[0]}; only there {only[1]}"
    return None
