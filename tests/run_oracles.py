"""Run every registered query against its oracle: ``python tests/run_oracles.py
[sf_dir] [key ...]``.  Prints one line per query and exits non-zero on a
mismatch."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from revlens.session import local_session  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = local_session(8)
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(q):
        t = time.time()
        try:
            df = q[k](spark, sf)
            if k in o:
                r = compare(df, o[k], con)
            else:
                r = {"rows_spark": df.count(), "ok": True, "oracle": "none"}
        except Exception as e:  # report and go on
            r = {"ok": False, "error": repr(e)[:800]}
        r["sec"] = round(time.time() - t, 2)
        bad += not r["ok"]
        print(k, json.dumps(r, default=str), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
