"""Time the headline queries: one JSON line with seconds per query and their sum.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendlake.plans.catalog import QUERIES  # noqa: E402
from spendlake.operators import cleaning, enrich  # noqa: E402
from spendlake.plans import testdata  # noqa: E402
from spendlake.session import get_spark, scratch_dir  # noqa: E402
from spendlake.sources import read_transactions_csv  # noqa: E402

HEADLINE = (
    "financial_overview",
    "silver_transactions",
    "monthly_spend",
    "time_series_features",
    "user_portfolio_features",
    "portfolio_recommendations",
    "card_offers",
    "category_spend_profile",
    "client_snapshots_one_pass",
    "advisor_plan",
    "holdout_split",
    "daily_refresh",
    "forecast_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    folder = tempfile.TemporaryDirectory(prefix="bench-")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        {
            "spark.checkpoint.dir": folder.name,"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")

    raw = f"{scratch_dir(spark)}/raw"
    testdata.dirty_transactions(spark, sf_dir).write.csv(raw, header=True, quote="\u0000")

    def silver_from_files(spark, _):
        """The silver stage from stored raw files; writing them is not timed."""
        enriched = enrich.add_category(read_transactions_csv(spark, raw), testdata.mcc_codes(spark))
        return cleaning.clean_transactions(enriched)

    queries = QUERIES | {"silver_transactions": silver_from_files}

    def run(name: str) -> None:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("financial_overview")  # JVM warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()
    folder.cleanup()


if __name__ == "__main__":
    main()
