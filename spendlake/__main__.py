"""The daily job for ``spark-submit``: raw files to all tables, optionally with the forecaster.

``spark-submit --py-files spendlake.zip run.py`` or, locally, ``python -m spendlake --help``.
"""

from __future__ import annotations

import argparse

from spendlake.operators.forecast import TARGETS
from spendlake.plans import daily
from spendlake.session import get_spark
from spendlake.sources.lake import DEFAULT_FORMAT


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="spendlake", description=__doc__.splitlines()[0])
    parser.add_argument("--transactions", required=True, help="transaction CSV: file, folder or glob")
    parser.add_argument("--users", required=True, help="user CSV: file, folder or glob")
    parser.add_argument("--mcc", required=True, help="category dictionary, one JSON object")
    parser.add_argument("--out", required=True, help="root folder of the lake")
    parser.add_argument("--format", default=DEFAULT_FORMAT, help="table format, e.g. parquet or delta")
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    parser.add_argument("--bucketed-as", help="catalog table that holds the monthly roll-up by client")
    parser.add_argument("--buckets", type=int, help="default: by the size of the roll-up")
    parser.add_argument(
        "--stages", nargs="+", choices=(*daily.STAGES, *daily.MODEL_STAGES), default=daily.STAGES,
        help="default: all but the forecaster and the advisor, which plans with the saved model",
    )
    parser.add_argument("--parse-dates", action="store_true", help="store dates as timestamps")
    parser.add_argument("--by-month", action="store_true", help="partition silver transactions by month")
    parser.add_argument(
        "--incremental", action="store_true", help="take only files added to the transaction folder since the last run"
    )
    parser.add_argument("--min-history", type=int, default=0, help="earlier months a series row needs")
    parser.add_argument("--shuffle-bytes", type=int, help="size of the largest expected exchange")
    parser.add_argument("--train", choices=sorted(TARGETS), help="also train on this target and advise")
    parser.add_argument("--trees", type=int, default=200)
    parser.add_argument("--depth", type=int, default=6)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = get_spark(
        "spendlake-daily",
        args.master,
        delta=args.format == "delta",
        shuffle_bytes=args.shuffle_bytes,
    )
    lake = daily.run_pipeline(
        spark, args.transactions, args.users, args.mcc, args.out, args.format,
        args.bucketed_as, args.buckets, args.stages, args.parse_dates, args.by_month, args.min_history,
        incremental=args.incremental,
    )
    if args.train:
        daily.refresh_forecaster(spark, lake, args.train, args.trees, args.depth)
        daily.refresh_advisor(spark, lake)


if __name__ == "__main__":
    main()
