"""Run registered queries and their SQL on one folder of tables and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [name-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

from .registry import all_checks, runner


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder: str, check) -> str | None:
    """None when the rows agree, else what differs."""
    df = runner(check)(spark, folder)
    names = df.columns
    got = _rows(names, [tuple(r) for r in df.collect()])
    if check.sql is None:
        return None if got else "no rows"
    cursor = con.execute(check.sql)
    want_names = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    want = _rows(want_names, cursor.fetchall())
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} against {sorted(want_names)}"
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for field in df.schema.fields:
        kind = kinds.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != want_types[field.name]:
            return f"type of {field.name}: {kind} against {want_types[field.name]}"
    if got != want:
        extra = sorted(set(got) - set(want))[:2]
        lacking = sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows against {len(want)}; extra {extra}; missing {lacking}"
    return None if got else "EMPTY on both sides"


def main() -> int:
    from rosterlake.session import local_session

    folder, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = local_session("compare", 8)
    con = connect(folder)
    bad = 0
    checks = {n: c for n, c in all_checks().items() if not prefixes or n.startswith(prefixes)}
    for name, check in checks.items():
        start = time.time()
        try:
            problem = compare(spark, con, folder, check)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        if problem:
            bad += 1
            print(f"FAIL {name} ({took:.1f}s): {problem[:900]}", flush=True)
        elif took > 5:
            print(f"slow {name}: {took:.1f}s", flush=True)
    print(f"{len(checks) - bad} of {len(checks)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
