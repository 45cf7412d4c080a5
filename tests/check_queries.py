"""Compare queries with their SQL: python tests/check_queries.py [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if abs(v) > 1e9 else f"{round(v, 6):.6f}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return str(v)
    return repr(v) if isinstance(v, str) else str(v)


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = queries()[name](spark, sf_dir)
    got = df.collect()
    seconds = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"rows={len(got)} {seconds:.1f}s (no SQL)"
    done = con.execute(sql)
    names = [d[0] for d in done.description]
    want = done.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        extra = [x for x in a if x not in set(b)][:3]
        lack = [x for x in b if x not in set(a)][:3]
        return False, f"{len(a)} vs {len(b)} rows\n   spark {extra}\n   sql   {lack}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_kinds = {d[0]: str(d[1]) for d in done.description}
    note = [f"{c}:{kinds[c]}/{duck_kinds[c]}" for c in sorted(kinds)
            if duck_kinds[c] in ("HUGEINT",) or (kinds[c] == "double") != (duck_kinds[c] == "DOUBLE")]
    return True, f"rows={len(a)} {seconds:.1f}s {' '.join(note)}"


if __name__ == "__main__":
    from lakewright.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{sf}"
    spark, con = local_session("8"), duck(folder)
    bad = 0
    for q in sys.argv[2:] or queries():
        try:
            good, text = compare(spark, con, q, folder)
        except Exception as error:  # report and go on
            good, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not good
        print("ok  " if good else "FAIL", q, text, flush=True)
    print("failures:", bad)
