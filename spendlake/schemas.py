"""Table schemas and the fixed dimensions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def _struct(text: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike the DDL parser it needs no running session."""
    fields = [field.split() for field in text.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


BRONZE_TRANSACTIONS = _struct(
    "id string, date string, client_id string, card_id string, amount string, use_chip string, "
    "merchant_id string, merchant_city string, merchant_state string, zip string, mcc string, "
    "errors string"
)

BRONZE_USERS = _struct(
    "id string, current_age int, retirement_age int, birth_year int, birth_month int, "
    "gender string, address string, latitude float, longitude float, per_capita_income string, "
    "yearly_income string, total_debt string, credit_score int, num_credit_cards int"
)

USER_MONEY_COLUMNS = ("per_capita_income", "yearly_income", "total_debt")

MCC_CODES = _struct("mcc string, category_name string")

TIME_SERIES_FEATURES = _struct(
    "client_id string, txn_month string, current_month_spend double, spend_1_month_ago double, "
    "spend_2_months_ago double, spend_3_months_ago double, avg_spend_last_3_months double"
)

USER_PORTFOLIO_FEATURES = _struct(
    "id string, current_age int, retirement_age int, birth_year int, birth_month int, "
    "gender string, address string, latitude float, longitude float, per_capita_income double, "
    "yearly_income double, total_debt double, credit_score int, num_credit_cards int, "
    "client_id string, avg_monthly_spend double, avg_monthly_discretionary double, "
    "monthly_income double, investment_horizon int, credit_utilization_ratio double, "
    "monthly_disposable_income double, savings_rate double, discretionary_spend_ratio double, "
    "risk_tolerance_score int"
)

ADVISOR_REQUEST = _struct(
    "client_id string, monthly_income double, risk_score int, investment_horizon int, "
    "current_month_spend double, spend_1_month_ago double, spend_2_months_ago double"
)

# Money is summed as decimals, so totals do not depend on the order rows arrive in. Ten places hold
# any amount a file may carry; a sum of these is decimal(38,10).
MONEY = T.DecimalType(28, 10)

# Exclusive bounds of the silver filter, inclusive bounds of the record contract.
AMOUNT_BOUND = 1_000_000

UNKNOWN_CATEGORY = "UNKNOWN"
DEFAULT_CATEGORY = "Uncategorized"

# Categories counted as discretionary, upper case as in the silver table.
DISCRETIONARY_CATEGORIES = (
    "EATING PLACES AND RESTAURANTS",
    "FAST FOOD RESTAURANTS",
    "DRINKING PLACES (ALCOHOLIC BEVERAGES)",
    "AMUSEMENT PARKS, CARNIVALS, CIRCUSES",
    "MOTION PICTURE THEATERS",
    "BOOK STORES",
    "DEPARTMENT STORES",
    "DISCOUNT STORES",
    "SHOE STORES",
    "COSMETIC STORES",
    "MISCELLANEOUS HOME FURNISHING STORES",
    "GIFT, CARD, NOVELTY STORES",
    "POTTERY AND CERAMICS",
    "LEATHER GOODS",
    "TRAVEL AGENCIES",
    "LODGING - HOTELS, MOTELS, RESORTS",
    "PASSENGER RAILWAYS",
    "RAILROAD PASSENGER TRANSPORT",
    "GARDENING SUPPLIES",
)


class Asset(NamedTuple):
    name: str
    annual_return: float
    risk: float
    min_horizon: int | None = None


class CardProduct(NamedTuple):
    name: str
    revenue: int
    risk_cost: int


# Yearly return, risk points, and the shortest horizon an asset may be held for.
ASSETS = (
    Asset("Savings", 0.02, 1),
    Asset("Bonds", 0.04, 3),
    Asset("ETFs", 0.08, 6),
    Asset("Crypto", 0.15, 10, min_horizon=5),
)

# Expected revenue and risk cost per card product.
CARD_PRODUCTS = (
    CardProduct("Basic_Debit", 20, 10),
    CardProduct("Standard_Credit", 100, 150),
    CardProduct("Cashback_Rewards", 150, 250),
    CardProduct("Platinum_Travel", 300, 500),
)

# At most two products per client, and never these two together.
MAX_CARDS = 2
EXCLUSIVE_CARDS = (("Platinum_Travel", "Basic_Debit"),)

# What a visitor without an account starts from.
GUEST_PROFILE = {
    "client_id": "Guest",
    "monthly_income": 5000.0,
    "risk_score": 5,
    "investment_horizon": 15,
    "current_month_spend": 2000.0,
    "spend_1_month_ago": 2100.0,
    "spend_2_months_ago": 1900.0,
}
