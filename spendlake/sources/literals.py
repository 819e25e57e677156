"""Small frames from Python values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendlake.schemas import (
    ADVISOR_REQUEST,
    ASSETS,
    CARD_PRODUCTS,
    GUEST_PROFILE,
    Asset,
    CardProduct,
)


def rows_table(
    spark: SparkSession,
    rows: Mapping | Sequence[Mapping],
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """One dict, or a list of dicts, as rows. Give ``schema`` where a column may be all null."""
    records = [dict(rows)] if isinstance(rows, Mapping) else [dict(r) for r in rows]
    return spark.createDataFrame(records, schema)


def asset_table(spark: SparkSession, assets: Sequence[Asset] = ASSETS) -> DataFrame:
    return spark.createDataFrame(
        [(a.name, float(a.annual_return), float(a.risk), a.min_horizon) for a in assets],
        "asset string, annual_return double, risk double, min_horizon int",
    )


def card_product_table(
    spark: SparkSession, products: Sequence[CardProduct] = CARD_PRODUCTS
) -> DataFrame:
    return spark.createDataFrame(
        [(p.name, p.revenue, p.risk_cost) for p in products],
        "product string, revenue int, risk_cost int",
    )


def guest_request(spark: SparkSession, **changes) -> DataFrame:
    """The one-row advisor request of a visitor without an account, with any fields changed."""
    row = {**GUEST_PROFILE, **changes}
    return spark.createDataFrame([tuple(row[f.name] for f in ADVISOR_REQUEST)], ADVISOR_REQUEST)
