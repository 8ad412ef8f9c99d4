"""Run a report by name: ``python -m quill list`` /
``python -m quill run NAME --data DIR [--as-of YYYY-MM-DD] [--param k=v ...]
[--out PATH] [--show N]`` / ``python -m quill run-all --data DIR --out DIR``.

Parameters replace the reference's interactive prompts and bind variables
(income range, thresholds, exchange rate, …): each ``--param`` is passed to
the report builder as a keyword argument.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import sys


def _value(text: str):
    """An integer, an exact decimal number, or the text itself."""
    for conv in (int, decimal.Decimal):
        try:
            return conv(text)
        except (ValueError, decimal.InvalidOperation):
            pass
    return text


def main(argv=None) -> int:
    from quill.plans.registry import BUILDERS

    ap = argparse.ArgumentParser(prog="quill")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list report names")
    run = sub.add_parser("run", help="run one report")
    run.add_argument("name", choices=sorted(BUILDERS))
    run.add_argument("--data", required=True, help="folder with <table>.parquet inputs")
    run.add_argument("--as-of", default=None, help="run date (default 2001-08-15)")
    run.add_argument("--param", action="append", default=[], help="builder keyword k=v")
    run.add_argument("--out", default=None, help="write the result as Parquet here")
    run.add_argument("--show", type=int, default=20, help="rows to print (0: none)")
    batch = sub.add_parser("run-all", help="write every side-effect-free report as Parquet")
    batch.add_argument("--data", required=True, help="folder with <table>.parquet inputs")
    batch.add_argument("--out", required=True, help="folder for <report>/ outputs (shared storage)")
    batch.add_argument("--as-of", default=None, help="run date (default 2001-08-15)")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name in sorted(BUILDERS):
            doc = (BUILDERS[name].__doc__ or "").strip().splitlines()
            print(f"{name:24s} {doc[0] if doc else ''}")
        return 0

    from pyspark.sql import SparkSession

    from quill.plans.context import Ctx
    from quill.session import shared_dir

    spark = SparkSession.builder.appName(f"quill-{getattr(args, 'name', 'all')}").getOrCreate()
    shared_dir(spark)
    ctx = Ctx(spark, args.data)
    if args.as_of:
        ctx.as_of = dt.date.fromisoformat(args.as_of)
    if args.cmd == "run-all":
        from quill.plans.registry import EAGER, WRITERS
        for name, fn in BUILDERS.items():
            if name in WRITERS or name in EAGER:
                continue
            fn(ctx).write.mode("errorifexists").parquet(f"{args.out.rstrip('/')}/{name}")
            print(name)
        return 0
    kwargs = dict(p.split("=", 1) for p in args.param)
    df = BUILDERS[args.name](ctx, **{k: _value(v) for k, v in kwargs.items()})
    if args.out:
        df.write.mode("errorifexists").parquet(args.out)
    if args.show:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
