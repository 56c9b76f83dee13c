"""Run every registered query against its DuckDB oracle (like the driver's correctness gate).
Usage: python tests/run_oracle.py [spark.conf=value ...] [sf_dir] [key ...]"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tillsight.oracle.compare import compare, duckdb_connection  # noqa: E402
from tillsight.session import get_session  # noqa: E402


def main():
    args = sys.argv[1:]
    confs = [a.split("=", 1) for a in args if "=" in a and a.startswith("spark.")]
    args = [a for a in args if not (a.startswith("spark.") and "=" in a)]
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:]
    if confs:      # a session configured unlike ours, e.g. the driver's defaults
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        for k, v in confs:
            b = b.config(k, v)
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duckdb_connection(sf)
    bad = 0
    for k in (keys or list(qs)):
        t = time.time()
        try:
            df = qs[k](spark, sf)
            if k in orc:
                res = compare(df, con, orc[k])
            else:
                res = {"ok": None, "spark_rows": df.count(), "note": "no oracle"}
        except Exception as e:  # noqa: BLE001
            res = {"ok": False, "error": repr(e)[:800]}
        res["sec"] = round(time.time() - t, 2)
        if res.get("ok") is False:
            bad += 1
        brief = {x: res[x] for x in res if x not in ("spark_cols", "oracle_cols") or not res.get("columns_match", True)}
        print(k, json.dumps(brief, default=str), flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main()
