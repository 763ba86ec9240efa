"""Command line: build the six tables, or run one of the sales queries.

    python -m orderlens normalize <wide-text-path> <out-dir> [--lenient]
    python -m orderlens query <q01..q11> <out-dir-of-normalize> [--customer NAME] [--show N]
    python -m orderlens query <q01..q11> --star <star-schema-dir> [--customer NAME]

``query`` prints the first rows (``--show``, default 20); results are
DataFrames, so library users call the functions directly instead.
"""

from __future__ import annotations

import argparse
import sys

from orderlens.plans import analytics as A
from orderlens.plans.normalize import normalize, open_normalized
from orderlens.session import build_session
from orderlens.sources.star import star_model

QUERIES = {
    "q01": A.q01_customer_orders, "q02": A.q02_customer_total,
    **{k[:3]: fn for k, fn in A.ALL_QUERIES.items()},
}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="orderlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    n = sub.add_parser("normalize", help="wide text -> six tables (Parquet)")
    n.add_argument("path")
    n.add_argument("out_dir")
    n.add_argument("--lenient", action="store_true", help="bad values go to the rejects")
    q = sub.add_parser("query", help="run one sales query")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("tables", nargs="?", help="output folder of `normalize`")
    q.add_argument("--star", help="star-schema folder instead of normalised tables")
    q.add_argument("--customer", help="customer name for q01/q02")
    q.add_argument("--show", type=int, default=20)
    args = ap.parse_args(argv)

    spark = build_session()
    if args.cmd == "normalize":
        out = normalize(spark, args.path, args.out_dir, strict=not args.lenient)
        for t in ("Region", "Country", "Customer", "ProductCategory", "Product", "OrderDetail"):
            print(f"{t}: {out.table(t).count()} rows")
        print(f"rejects: {out.rejects.count()} rows; tables in {out.out_dir}")
        return 0
    if not args.star and not args.tables:
        ap.error("query needs the normalised tables folder or --star")
    model = star_model(spark, args.star) if args.star else open_normalized(spark, args.tables).model()
    fn = QUERIES[args.name]
    if args.name in ("q01", "q02"):
        if not args.customer:
            ap.error("q01/q02 need --customer")
        df = fn(model, args.customer)
    else:
        df = fn(model)
    df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
