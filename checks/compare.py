"""Run the registered queries next to their SQL and compare whole results.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES


TYPES = {"string": "varchar", "int": "integer"}


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return str(v) if v is not None and not isinstance(v, (bool, float)) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf: str, name: str, con) -> str:
    t0 = time.time()
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    t1 = time.time()
    if name not in ORACLE:
        return f"rows  {name}: {len(got[1])} rows, spark {t1 - t0:.1f}s"
    rel = con.execute(ORACLE[name])
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    times = f"spark {t1 - t0:.1f}s sql {time.time() - t1:.1f}s"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for column in rel.description:
        kind, mine = str(column[1]).lower(), spark_types.get(column[0])
        if TYPES.get(mine, mine) != kind:
            times += f" [{column[0]}: {mine} vs {kind}]"
    if got == want:
        return f"ok    {name}: {len(got[1])} rows, {times}"
    if got[0] != want[0]:
        return f"DIFF  {name}: columns {got[0]} vs {want[0]}"
    extra = [x for x in got[1] if x not in set(want[1])][:3]
    missing = [x for x in want[1] if x not in set(got[1])][:3]
    return (f"DIFF  {name}: {len(got[1])} vs {len(want[1])} rows, {times}\n  {got[0]}\n"
            f"  only spark {extra}\n  only sql   {missing}")


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def main() -> int:
    from bench import session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con, bad = session(), connect(sf), 0
    for name in names:
        try:
            line = compare(spark, sf, name, con)
        except Exception as exc:  # report and go on with the next query
            line = f"FAIL  {name}: {str(exc)[:1200]}"
        bad += not line.startswith(("ok", "rows"))
        print(line, flush=True)
    print(f"{len(names)} queries, {bad} not matching")
    return bad


if __name__ == "__main__":
    sys.exit(main())
