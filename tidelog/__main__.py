"""`python -m tidelog list | run QUERY FOLDER | explain QUERY FOLDER | workload N OUT`"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidelog.plans import apply_queries, stream_queries  # noqa: F401  they register their queries
from tidelog.plans.feeds import ORACLES, QUERIES
from tidelog.sources import workload


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidelog", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    for name in ("run", "explain", "sql"):
        one = commands.add_parser(name)
        one.add_argument("query", choices=sorted(QUERIES), metavar="QUERY")
        if name != "sql":
            one.add_argument("folder")
    made = commands.add_parser("workload", help="write a deterministic workload")
    made.add_argument("n", type=int)
    made.add_argument("out")
    args = parser.parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    if args.command == "sql":
        print(ORACLES.get(args.query, "none"))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if args.command == "workload":
        workload.steps(spark, args.n).write.parquet(args.out)
    elif args.command == "explain":
        QUERIES[args.query](spark, args.folder).explain("formatted")
    else:
        QUERIES[args.query](spark, args.folder).show(50, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
