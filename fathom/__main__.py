"""Command line: list, explain, run or export the registered queries.

    python -m fathom list
    python -m fathom run e46_either_key_left --data /path/to/tables [--show 20]
    python -m fathom run e69_running_balance --data DIR --out /path/out --format parquet
    python -m fathom sql e46_either_key_left          # the SQL formulation
    python -m fathom explain e46_either_key_left --data DIR
"""

from __future__ import annotations

import argparse
import sys

from fathom.plans.registry import load_all, run
from fathom.session import build_session
from fathom.sources.sql_views import with_views


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fathom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain", "sql"):
        p = sub.add_parser(name)
        p.add_argument("key")
        if name != "sql":
            p.add_argument("--data", required=True, help="directory with <table>.parquet")
            p.add_argument("--master", default=None)
        if name == "run":
            p.add_argument("--show", type=int, default=20)
            p.add_argument("--out", default=None, help="write the result here instead of showing it")
            p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    args = ap.parse_args(argv)
    registry = load_all()
    if args.cmd == "list":
        for key, q in registry.items():
            print(f"{key:28s} {q.doc.splitlines()[0] if q.doc else ''}")
        return 0
    if args.key not in registry:
        print(f"unknown query {args.key!r}", file=sys.stderr)
        return 2
    if args.cmd == "sql":
        print(with_views(registry[args.key].sql) if registry[args.key].sql else "(no SQL formulation)")
        return 0
    spark = build_session(args.master)
    df = run(spark, args.data, args.key)
    if args.cmd == "explain":
        df.explain("formatted")
    elif args.out:
        writer = df.write.mode("overwrite").format(args.format)
        if args.format == "csv":
            writer = writer.option("header", "true")
        writer.save(args.out)
        print(f"wrote {args.out}")
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
