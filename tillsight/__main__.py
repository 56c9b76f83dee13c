"""Command line: build a star from raw lines, or run a mart over a saved star.

    python -m tillsight build --testdata /root/testdata/sf0.1 --out /shared/star
    python -m tillsight build --part "Year 2009-2010=/raw/y1.csv" --part "Year 2010-2011=/raw/y2.csv" \\
        --format csv --snapshot 2012-01-01 --out /shared/star
    python -m tillsight mart monthly_growth --star /shared/star [--out /shared/marts/monthly_growth]
    python -m tillsight mart rfm_segments --star /shared/star --param snapshot=2012-01-01

On a cluster, run it with spark-submit; the session's master and ``spark.checkpoint.dir`` come
from the submit configuration.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from tillsight.session import get_session
    return get_session()


def _build(args) -> None:
    from tillsight import warehouse
    from tillsight.operators.star import StarConfig, build_star
    from tillsight.sources.raw import read_transactions
    from tillsight.sources.sinks import save_star

    spark = _session()
    if args.testdata:
        raw = warehouse.raw(spark, args.testdata)
        cfg = warehouse.testdata_config(spark, args.testdata, key_mode=args.keys)
    else:
        parts = dict(p.split("=", 1) for p in args.part)
        raw = read_transactions(spark, parts, fmt=args.format)
        cfg = StarConfig(snapshot=args.snapshot, key_mode=args.keys)
    star = build_star(raw, cfg)
    paths = save_star(star.tables(), args.out, partition_fact_by_month=args.partition_by_month, snapshot=star.snapshot)
    for name, path in paths.items():
        print(name, spark.read.parquet(path).count(), path)


def _mart(args) -> None:
    from tillsight import plans
    from tillsight.operators.star import SNAPSHOT, Star
    from tillsight.sources.sinks import load_star, saved_snapshot

    spark = _session()
    marts = plans.registry()
    if args.name not in marts:
        sys.exit(f"unknown mart {args.name!r}; one of: {', '.join(sorted(marts))}")
    t = load_star(spark, args.star)
    # Without a saved order grain the marts aggregate the fact themselves.
    star = Star(t["dim_customer"], t["dim_product"], t["dim_date"], t["dim_location"], t["fact_sales"],
                fact_orders=t.get("fact_orders"), order_bits=t.get("order_bits"), snapshot=saved_snapshot(spark, args.star) or SNAPSHOT)
    df = marts[args.name](star, **typed(marts[args.name], dict(p.split("=", 1) for p in (args.param or []))))
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)


def typed(mart, params: dict[str, str]) -> dict:
    """Parameters from the command line, by the types of the mart's signature."""
    known = inspect.signature(mart).parameters
    out = {}
    for k, v in params.items():
        if k not in known or k == "star":
            raise SystemExit(f"unknown parameter {k!r}; one of: {', '.join(x for x in known if x != 'star') or 'none'}")
        default = known[k].default
        kind = type(default) if default is not None and default is not inspect.Parameter.empty else str
        out[k] = tuple(int(x) for x in v.split(",")) if kind is tuple else kind(v)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tillsight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="raw lines → star schema (written)")
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--testdata", help="folder of the driver's TPC-H-shaped parquet tables")
    src.add_argument("--part", action="append", help="NAME=PATH of one raw part (repeat per part)")
    b.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    b.add_argument("--snapshot", default="2012-01-01")
    b.add_argument("--keys", default="dense", choices=["dense", "hash"])
    b.add_argument("--partition-by-month", action="store_true")
    b.add_argument("--out", required=True)
    m = sub.add_parser("mart", help="run one mart over a saved star")
    m.add_argument("name")
    m.add_argument("--star", required=True)
    m.add_argument("--out")
    m.add_argument("--rows", type=int, default=50)
    m.add_argument("--param", action="append", help="KEY=VALUE for the mart, e.g. snapshot=2012-01-01")
    args = ap.parse_args(argv)
    {"build": _build, "mart": _mart}[args.cmd](args)


if __name__ == "__main__":
    main()
