"""Run registered queries in Spark and their DuckDB oracles; compare rows.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__file__)))

from capgrid.plans.fixtures import BASE_TABLES  # noqa: E402
from capgrid.plans.queries import ORACLES, QUERIES  # noqa: E402
from capgrid.session import local_session  # noqa: E402
from compare import differences  # noqa: E402

TABLES = BASE_TABLES


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(int(__import__('os').environ.get('CPUS', '8')))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    ok = bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = df.collect()
            scols = df.columns
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(exc)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = ORACLES.get(name)
        if sql is None:
            print(f"rows {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sql)
            dcols = [c[0] for c in res.description]
            drows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(exc)[:600]}")
            bad += 1
            continue
        wrong = differences(srows, scols, drows, dcols)
        ok, bad = (ok + 1, bad) if not wrong else (ok, bad + 1)
        print(f"{'FAIL' if wrong else 'ok  '} {name}: {len(srows)} rows {ts:.1f}s {wrong or ''}", flush=True)
    print(f"{ok} ok, {bad} failed")
    spark.stop()


if __name__ == "__main__":
    main()
