"""CLI: run registered queries at an SF dir and compare with the DuckDB oracle.

    python tests/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from panelforge.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(int(os.environ.get("CHECK_CPUS", "8")))
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for n in names or sorted(qs):
        t = time.time()
        try:
            df = qs[n](spark, sf)
            if n in sqls:
                res = compare(df, sqls[n], con)
            else:
                res = {"spark_rows": df.count(), "match": None}
        except Exception as e:  # noqa: BLE001
            res = {"error": f"{type(e).__name__}: {str(e)[:400]}", "match": False}
        res["sec"] = round(time.time() - t, 2)
        bad += res.get("match") is False
        print(n, json.dumps(res, default=str), flush=True)
    print("MISMATCHES", bad)


if __name__ == "__main__":
    main()
