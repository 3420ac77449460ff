"""Run registered queries beside their SQL and compare types and values.

    python tools/compare.py [SF_DIR] [NAME_PREFIX ...]
"""

from __future__ import annotations

import hashlib
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from rollcall.plans.registry import oracle_sql, queries  # noqa: E402
from rollcall.session import build_session  # noqa: E402

KINDS = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def rows_of(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(v[i] for i in order)) for v in values)


def main() -> int:
    args = sys.argv[1:]
    directory = args[0] if args else "/root/testdata/sf0.01"
    prefixes = tuple(args[1:])
    spark = build_session("local[8]")
    con = duckdb.connect()
    for path in Path(directory).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    sqls, bad, unchecked = oracle_sql(), [], 0
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, directory)
            got = [tuple(r) for r in df.collect()]
            spent = time.time() - start
            if name not in sqls:
                unchecked += 1
                print(f"rows  {name:38} {len(got):7} rows {spent:6.2f}s")
                continue
            res = con.execute(sqls[name])
            want_cols = {d[0]: str(d[1]) for d in res.description}
            want = res.fetchall()
            have_cols = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
            notes = []
            if have_cols != want_cols:
                diff = {k: (have_cols.get(k), want_cols.get(k)) for k in {*have_cols, *want_cols}}
                notes.append(f"columns {({k: v for k, v in diff.items() if v[0] != v[1]})}")
            mine, theirs = rows_of(df.columns, got), rows_of(list(want_cols), want)
            if mine != theirs:
                a = [r for r in mine if r not in set(theirs)][:2]
                b = [r for r in theirs if r not in set(mine)][:2]
                notes.append(f"rows {len(mine)} vs {len(theirs)}; only here {a}; only there {b}")
            digest = hashlib.md5("".join(mine).encode()).hexdigest()[:8]
            print(f"{'FAIL' if notes else 'ok'}    {name:38} {len(got):7} rows {spent:6.2f}s {digest} {' | '.join(notes)}")
            if notes:
                bad.append(name)
        except Exception as error:  # noqa: BLE001
            bad.append(name)
            print(f"ERROR {name}: {str(error)[:1500]}")
    print(f"{len(bad)} failed: {bad}; {unchecked} without SQL")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
