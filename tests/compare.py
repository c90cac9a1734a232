"""Compare a Spark result with the checking engine's, values and all, in any order."""

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def engine(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(repr(_plain(row[i])) for i in order) for row in rows
    )


def differences(df, con, sql):
    """Empty when equal, else a short account."""
    result = con.execute(sql)
    want_names, want = canonical([d[0] for d in result.description], result.fetchall())
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    extra, lacking = got - want, want - got
    if not extra and not lacking:
        return ""
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; {sum(extra.values())} extra, {sum(lacking.values())} lacking\n"
        f"{got_names}\n+ {list(extra)[:4]}\n- {list(lacking)[:4]}"
    )
