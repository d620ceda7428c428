"""Seconds that DuckDB takes for the oracle SQL of the headline queries, as our
own baseline: the driver tables are loaded first, each query starts from them.

usage: python tools/duckdb_baseline.py [sf_dir] [threads]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from ledgerline.plans.catalog import REGISTRY  # noqa: E402
from ledgerline.sources.fixture import TABLES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"SET threads = {int(sys.argv[2]) if len(sys.argv) > 2 else 8}")
    for t in TABLES:
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    out = {}
    for name in HEADLINE:
        t0 = time.time()
        con.sql(REGISTRY[name].oracle()).arrow()
        out[name] = round(time.time() - t0, 3)
    print(json.dumps({"sf_dir": sf, "seconds": out, "total": round(sum(out.values()), 2)}))


if __name__ == "__main__":
    main()
