"""Bronze to silver: typed, bounded, complete rows, and the record contract with its rejects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import (
    clean_category,
    clean_merchant,
    in_bounds,
    parse_money,
    parse_timestamp,
)
from spendlake.schemas import (
    AMOUNT_BOUND,
    BRONZE_TRANSACTIONS,
    DEFAULT_CATEGORY,
    USER_MONEY_COLUMNS,
)

_ISO_DATE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"


def clean_transactions(enriched: DataFrame, parse_dates: bool = False) -> DataFrame:
    """Silver transactions from raw ones that already carry ``category_name``.

    Unparseable amounts become null and drop out with the bounds filter, and so do rows without
    id or client. ``parse_dates`` turns ``date`` into a timestamp; without it the text is kept.
    """
    date = parse_timestamp(F.col("date")) if parse_dates else F.col("date")
    replaced = {
        "date": date,
        "amount": parse_money(F.col("amount")),
    }
    order = ["mcc"] + [c for c in BRONZE_TRANSACTIONS.fieldNames() if c != "mcc"]
    return (
        enriched.filter(F.col("id").isNotNull() & F.col("client_id").isNotNull())
        .select(
            *[replaced.get(c, F.col(c)).alias(c) for c in order],
            clean_category(F.col("category_name")).alias("category_name"),
        )
        .filter(in_bounds(F.col("amount")))
    )


def clean_users(raw: DataFrame) -> DataFrame:
    """Silver users: money as double, rows without id or yearly income dropped."""
    typed = raw.withColumns({c: parse_money(F.col(c)) for c in USER_MONEY_COLUMNS})
    return typed.filter(F.col("id").isNotNull() & F.col("yearly_income").isNotNull())


class ContractResult(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def _first_error(column: Column, value: Column, name: str) -> Column:
    return F.when(column.isNull(), F.lit(f"missing {name}")).when(
        value.isNull(), F.lit(f"invalid {name}")
    )


def check_contract(records: DataFrame) -> DataFrame:
    """The records as the contract delivers them, plus ``reason``: every broken rule, or null.

    Input columns ``transaction_id, date, amount, merchant_name`` and optionally ``category``, as
    text or already typed. Amounts are accepted up to and including one million either way, which
    is wider than the silver filter, and rounded half-up to cents.
    """
    if "category" not in records.columns:
        records = records.withColumn("category", F.lit(None).cast("string"))
    date_text = F.col("date").cast("string")
    date = F.when(date_text.rlike(_ISO_DATE), F.col("date").try_cast("timestamp"))
    amount = F.col("amount").try_cast("double")
    # NaN compares as larger than any number here but fails both comparisons of the contract.
    out_of_range = (F.abs(amount) > F.lit(float(AMOUNT_BOUND))) & ~F.isnan(amount)
    reasons = F.concat_ws(
        "; ",
        F.when(F.col("transaction_id").isNull(), F.lit("missing transaction_id")),
        _first_error(F.col("date"), date, "date"),
        F.coalesce(
            _first_error(F.col("amount"), amount, "amount"),
            F.when(out_of_range, F.lit("amount out of range")),
        ),
        F.when(F.col("merchant_name").isNull(), F.lit("missing merchant_name")),
    )
    return records.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        date.alias("date"),
        F.round(amount, 2).alias("amount"),
        clean_merchant(F.col("merchant_name")).alias("merchant_name"),
        F.coalesce(F.col("category"), F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.nullif(reasons, F.lit("")).alias("reason"),
        *[F.col(c).cast("string").alias(f"raw_{c}") for c in ("date", "amount", "merchant_name")],
    )


def store_contract(records: DataFrame, path: str) -> ContractResult:
    """Judge the records in one pass, store them by verdict, and read either side from there."""
    accepted = F.col("reason").isNull()
    judged = check_contract(records).withColumn("accepted", accepted)
    judged.write.mode("overwrite").partitionBy("accepted").parquet(path)
    stored = records.sparkSession.read.schema(judged.schema).parquet(path)
    return _sides(stored.filter("accepted"), stored.filter("NOT accepted"))


def split_contract(records: DataFrame) -> ContractResult:
    """Accepted records, and the rejected ones with their raw fields and the reason.

    Lazy: whoever writes both sides scans the records twice and should use :func:`store_contract`.
    """
    checked = check_contract(records)
    return _sides(checked.filter("reason IS NULL"), checked.filter("reason IS NOT NULL"))


def _sides(valid: DataFrame, rejected: DataFrame) -> ContractResult:
    return ContractResult(
        valid=valid.select(
            "transaction_id", "date", "amount", "merchant_name", "category"
        ),
        rejected=rejected.select(
            "transaction_id", "raw_date", "raw_amount", "raw_merchant_name", "category", "reason"
        ),
    )
