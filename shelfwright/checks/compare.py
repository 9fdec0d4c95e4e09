"""Run queries against their SQL twins: ``python -m shelfwright.checks.compare [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v == int(v) and abs(v) < 1e15 else round(v, 9)
    if hasattr(v, "as_tuple"):
        return _plain(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr), [names[i] for i in order]


def difference(df, con, sql: str) -> str | None:
    """None if the two results are equal, else a short account of the difference."""
    left, lcols = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    right, rcols = _rows(cols, cur.fetchall())
    if lcols != rcols:
        return f"columns {lcols} != {rcols}"
    if left == right:
        return None
    only = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
    return f"rows {len(left)} / {len(right)}; only here {only[0]}; only there {only[1]}"


def main(argv):
    from shelfwright.checks import all_queries
    from shelfwright.session import build_session

    queries, sqls = all_queries()
    folder = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, fn in queries.items():
        if argv and not any(a in name for a in argv):
            continue
        t = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                diff = difference(df, con, sqls[name])
                note = "ok" if diff is None else "DIFF " + diff
            else:
                note = f"no twin, {df.count()} rows"
        except Exception as e:  # report and go on
            note = f"ERROR {type(e).__name__} {str(e)[:600]}"
        bad += note.startswith(("DIFF", "ERROR"))
        print(f"{name:24s} {time.time() - t:6.2f}s {note[:1500]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
