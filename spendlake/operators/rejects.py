"""Which raw rows cleaning drops, and why, counted in the pass that writes the others.

Each row gets the first reason that applies, or none. The writer lets only rows without a reason through
and counts all of them on the way, so that the counts cost no second scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import in_bounds, parse_money
from spendlake.operators.cleaning import clean_transactions, clean_users
from spendlake.schemas import BRONZE_USERS
from spendlake.sources.files import MALFORMED, typed_or_null

ACCEPTED = "accepted"
MALFORMED_LINE = "malformed line"
MISTYPED = "mistyped field"
MISSING_ID = "missing id"
MISSING_CLIENT = "missing client"
MISSING_AMOUNT = "missing amount"
NO_NUMBER = "amount is no number"
OUT_OF_BOUNDS = "amount out of bounds"
NO_INCOME = "yearly income is no number"

TRANSACTION_REASONS = (MALFORMED_LINE, MISSING_ID, MISSING_CLIENT, MISSING_AMOUNT, NO_NUMBER, OUT_OF_BOUNDS)
USER_REASONS = (MALFORMED_LINE, MISTYPED, MISSING_ID, NO_INCOME)


def _first(reasons: Mapping[str, Column]) -> Column:
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in reasons.items()])


def judge_transactions(lines: DataFrame) -> DataFrame:
    """Adds ``reason`` to raw transaction lines; null marks a row that cleaning keeps."""
    amount = parse_money(F.col("amount"))
    return lines.withColumn(
        "reason",
        _first(
            {
                MALFORMED_LINE: F.col(MALFORMED).isNotNull(),
                MISSING_ID: F.col("id").isNull(),
                MISSING_CLIENT: F.col("client_id").isNull(),
                MISSING_AMOUNT: F.col("amount").isNull(),
                NO_NUMBER: amount.isNull(),
                OUT_OF_BOUNDS: ~in_bounds(amount),
            }
        ),
    )


def judge_users(lines: DataFrame) -> DataFrame:
    """Types raw user lines and adds ``reason``; null marks a row that cleaning keeps."""
    typed = typed_or_null(lines, BRONZE_USERS)
    return typed.withColumn(
        "reason",
        _first(
            {
                MALFORMED_LINE: F.col(MALFORMED).isNotNull(),
                MISTYPED: F.col("mistyped").isNotNull(),
                MISSING_ID: F.col("id").isNull(),
                NO_INCOME: parse_money(F.col("yearly_income")).isNull(),
            }
        ),
    )


def accepted_transactions(judged: DataFrame, parse_dates: bool = False) -> DataFrame:
    """Silver transactions from judged lines that carry ``category_name``."""
    return clean_transactions(judged.filter("reason IS NULL"), parse_dates)


def accepted_users(judged: DataFrame) -> DataFrame:
    """Silver users from judged lines."""
    return clean_users(judged.filter("reason IS NULL").select(*BRONZE_USERS.fieldNames()))


def write_counting(
    judged: DataFrame, reasons: Sequence[str], write: Callable[[DataFrame], None], reason: str = "reason"
) -> dict[str, int]:
    """Hand the judged rows to ``write``, which must write them once, and give the rows seen by reason.

    The counters belong to the tasks that read. Where the write has no shuffle each is counted once,
    when its task succeeds; behind a shuffle, a task repeated after a lost executor counts again.
    """
    observation = Observation()
    why = F.col(reason)
    counters = [F.count_if(why.isNull()).alias(ACCEPTED)]
    counters += [F.count_if(F.coalesce(why == r, F.lit(False))).alias(r) for r in reasons]
    write(judged.observe(observation, *counters))
    return dict(observation.get)


def reason_table(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """``reason, rows``, reasons without rows included."""
    return spark.createDataFrame(list(counts.items()), "reason string, rows long")
