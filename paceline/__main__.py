"""python -m paceline list | run QUERY --data FOLDER [--out FOLDER] [--explain]"""

from __future__ import annotations

import argparse

from .lineage import scratch
from .plans import registry
from .session import session


def main() -> None:
    ap = argparse.ArgumentParser(prog="paceline", description=__doc__)
    sub = ap.add_subparsers(dest="what", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("query", choices=sorted(registry.QUERIES))
    run.add_argument("--data", required=True)
    run.add_argument("--out")
    run.add_argument("--explain", action="store_true")
    run.add_argument("--master", default="local[*]")
    args = ap.parse_args()
    if args.what == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return
    spark = session(args.master)
    with scratch(spark):
        df = registry.QUERIES[args.query](spark, args.data)
        if args.explain:
            df.explain("formatted")
        elif args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()
