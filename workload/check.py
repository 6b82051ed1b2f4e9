"""Compare every query with its SQL twin in DuckDB: row count, column names, sorted values.

Run as ``python -m workload.check [folder] [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SPARK_TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "TIMESTAMP": "timestamp_ntz",
}


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return decimal.Decimal(value).normalize()
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def compare(df, con, sql: str) -> tuple[bool, str]:
    names = sorted(df.columns)
    ours = Counter(tuple(canonical(row[n]) for n in names) for row in df.collect())
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return False, f"columns {names} / {sorted(theirs_names)}"
    kinds = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1]).lower().replace(" ", "")) for d in result.description}
    differ = {n: (k, kinds[n]) for n, k in df.dtypes if k != kinds[n]}
    if differ:
        return False, f"types {differ}"
    order = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(canonical(row[i]) for i in order) for row in result.fetchall())
    note = f"{sum(ours.values())} rows"
    if ours == theirs:
        return True, note
    extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return False, f"{note}; SQL has {sum(theirs.values())}; only here {extra}; only there {missing}"


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def main(argv: list[str]) -> int:
    from tidelog.session import build_session
    from workload.oracle import ORACLE
    from workload.queries import REGISTRY

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = build_session(
        "check",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            start = time.time()
            ok, note = compare(REGISTRY[name](spark, sf_dir), con, ORACLE[name])
            note += f", {time.time() - start:.1f} s"
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
