"""Run registered queries against their SQL twins and report differences."""
from __future__ import annotations

import math
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    """Return ``(ok, message)``."""
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    exp_cols, exp = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != exp_cols:
        return False, f"columns {got_cols} != {exp_cols}"
    if got != exp:
        in_got, in_exp = set(got), set(exp)
        extra = [r for r in got if r not in in_exp][:3]
        lost = [r for r in exp if r not in in_got][:3]
        return False, f"rows {len(got)} vs {len(exp)}; columns {got_cols}; only spark {extra}; only sql {lost}"
    return True, f"{len(got)} rows"
