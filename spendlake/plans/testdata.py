"""The shared test tables read as bronze and silver inputs.

Transactions are order lines: the client and date come from the order, the category code from the
part, and the sign of the amount from the return flag. Parts are joined only for queries that look
at categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import clean_category
from spendlake.operators.cleaning import clean_users
from spendlake.operators.enrich import add_category
from spendlake.schemas import BRONZE_TRANSACTIONS, BRONZE_USERS
from spendlake.session import stored_bytes

# Part type -> category name. PROMO is left out, so that unknown codes occur.
CATEGORY_OF_PART_TYPE = {
    "ECONOMY": "Discount Stores",
    "SMALL": "Fast Food Restaurants",
    "MEDIUM": "Department Stores",
    "LARGE": "Industrial Supplies",
    "STANDARD": "Grocery Stores",
}


# Declared, so that opening a table runs no job to read a footer.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


#: A share of the orders: its number and how many there are.
Share = tuple[int, int]
WHOLE: Share = (0, 1)
#: Bytes of order lines in a share, and shares at most. Only one share's shuffle files are on disk at a time.
SHARE_BYTES, MOST_SHARES = 512 << 20, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mcc_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(CATEGORY_OF_PART_TYPE.items()), "mcc string, category_name string"
    )


def _cents() -> Column:
    # A hundredth of the line's price, half cents up. The price times 100 is the number of cents,
    # so flooring it needs no decimal rounding; the addend absorbs the binary noise of a half.
    return F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) + (0.5 + 1e-5))


def _is_income() -> Column:
    return F.col("l_returnflag") == "R"


def _amount_text() -> Column:
    sign = F.when(_is_income(), "$").otherwise("$-")
    whole = F.floor(_cents() / 100).cast("string")
    return F.concat(sign, whole, F.lit("."), F.lpad((_cents() % 100).cast("string"), 2, "0"))


def order_shares(spark: SparkSession, sf_dir: str) -> list[Share]:
    """The shares that raw transactions are made by, each in a pass of its own over the tables."""
    shares = min(MOST_SHARES, max(1, -(-stored_bytes(table(spark, sf_dir, "lineitem")) // SHARE_BYTES)))
    return [(number, shares) for number in range(shares)]


def _order_lines(spark: SparkSession, sf_dir: str, with_part: bool, share: Share = WHOLE) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    if share != WHOLE:  # Spark filters both sides by it, before they are shuffled
        lines = lines.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(share[1])) == share[0])
    if with_part:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return lines


def _line_column(name: str) -> Column:
    """One bronze column over the joined order lines, typed."""
    supplier = F.col("l_suppkey")
    match name:
        case "id":
            shipped = F.col("l_shipdate").cast("date").cast("string")
            keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            return F.concat_ws("-", *keys, F.replace(shipped, F.lit("-"), F.lit("")))
        case "date":
            return F.col("o_orderdate")
        case "client_id":
            return F.col("o_custkey").cast("string")
        case "card_id":
            return F.col("o_orderpriority")
        case "amount":
            return F.when(_is_income(), _cents()).otherwise(-_cents()) / 100
        case "use_chip":
            return F.lit("Chip Transaction")
        case "merchant_id":
            return supplier.cast("string")
        case "merchant_city":
            return F.concat(F.lit("City "), (supplier % 50).cast("string"))
        case "merchant_state":
            return F.concat(F.lit("S"), (supplier % 20).cast("string"))
        case "zip":
            return F.lpad((supplier % 100000).cast("string"), 5, "0")
        case "mcc":
            return F.col("p_type")
        case "errors":
            return F.lit(None).cast("string")
    raise KeyError(name)


def bronze_transactions(spark: SparkSession, sf_dir: str, share: Share = WHOLE) -> DataFrame:
    """All columns as text, amounts with a dollar sign, as the raw files hold them."""
    text = {
        "date": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "amount": _amount_text(),
    }
    lines = _order_lines(spark, sf_dir, True, share)
    names = BRONZE_TRANSACTIONS.fieldNames()
    return lines.select(*[text.get(n, _line_column(n)).alias(n) for n in names])


def dirty_transactions(spark: SparkSession, sf_dir: str, share: Share = WHOLE) -> DataFrame:
    """The same with rows that cleaning has to drop, told by the line's tax and return flag.

    A comma in the city makes a CSV line without quotes too long; further rows have an amount that
    is no number or out of bounds, or lack their id or their client.
    """
    lines = _order_lines(spark, sf_dir, True, share)
    tax, flag = F.col("l_tax"), F.col("l_returnflag")
    text = {
        "date": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "amount": F.when(tax == 0.07, "n/a").when((tax == 0.06) & (flag == "A"), "$1000000.00").otherwise(_amount_text()),
        "merchant_city": F.when(tax == 0.08, F.concat(_line_column("merchant_city"), F.lit(", West"))).otherwise(_line_column("merchant_city")),
        "id": F.when(~((tax == 0.05) & (flag == "N")), _line_column("id")),
        "client_id": F.when(~((tax == 0.04) & (flag == "R")), _line_column("client_id")),
    }
    return lines.select(*[text.get(n, _line_column(n)).alias(n) for n in BRONZE_TRANSACTIONS.fieldNames()])


def dirty_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as text, some with an age that is no number, an income that is none, or no id."""
    users = bronze_users(spark, sf_dir)
    users = users.select(*[F.col(c).cast("string").alias(c) for c in users.columns])
    horizon = F.col("retirement_age").cast("int") - F.col("current_age").cast("int")
    return users.withColumns(
        {
            "current_age": F.when(horizon == 3, "unknown").otherwise(F.col("current_age")),
            "yearly_income": F.when(horizon == 5, "none").otherwise(F.col("yearly_income")),
            "id": F.when(horizon != 7, F.col("id")),
        }
    )


def allocation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as requests, with budgets, risks and horizons that are missing, NaN or too low."""
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    budget = F.when(segment == "BUILDING", F.when(nation % 2 == 0, F.lit(float("nan")))).otherwise(F.col("c_acctbal"))
    risk = F.when(segment == "MACHINERY", F.when(nation < 20, (nation % 4).cast("double")).otherwise(F.lit(float("nan"))))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("client_id"),
        budget.alias("budget"),
        F.coalesce(risk, F.when(segment != "MACHINERY", (nation % 12).cast("double"))).alias("risk"),
        F.when(nation != 13, (F.col("c_custkey") % 11).cast("int")).alias("horizon"),
    )


def part_products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Thirty card products from the sizes of parts, and the pairs that exclude each other."""
    position = (F.col("p_size") % 30).alias("position")
    products = table(spark, sf_dir, "part").groupBy(position).agg(
        (50 + F.sum("p_partkey") % 400).alias("revenue"), (60 + F.sum("p_partkey") % 289).alias("risk_cost")
    )
    products = products.withColumn("product", F.concat(F.lit("Card_"), F.col("position").cast("string")))
    place = F.col("position")
    exclusions = products.select("product", F.explode(F.array(place + 1, 35 - place)).alias("p")).select(
        "product", F.concat(F.lit("Card_"), F.col("p").cast("string")).alias("other")
    )
    return products, exclusions


def part_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An asset per brand, type and size class of parts, some with a minimum horizon or without a return."""
    key, size = F.sum("p_partkey"), F.sum("p_size")
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_brand", "p_type", (F.col("p_size") % 3).alias("class"))
        .agg(key.alias("key"), size.alias("size"))
        .select(
            F.concat_ws("/", "p_brand", "p_type", "class").alias("asset"),
            F.when(F.col("key") % 11 != 0, F.col("key") % 997 / 1000).alias("annual_return"),
            (F.col("size") % 97 / 8).alias("risk"),
            F.when(F.col("size") % 10 != 0, F.col("size") % 10).cast("int").alias("min_horizon"),
        )
    )


def silver_transactions(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The named silver columns, or all, typed straight from the tables.

    The same values as cleaning :func:`bronze_transactions`, without writing amounts as text and
    parsing them again. ``date`` is a timestamp.
    """
    bronze = BRONZE_TRANSACTIONS.fieldNames()
    names = names or ("mcc", *[n for n in bronze if n != "mcc"], "category_name")
    categorized = "category_name" in names
    needed = {*names, "mcc"} if categorized else set(names)
    lines = _order_lines(spark, sf_dir, with_part="mcc" in needed)
    rows = lines.select(*[_line_column(n).alias(n) for n in bronze if n in needed])
    if categorized:
        rows = add_category(rows, mcc_codes(spark), small=True)
        rows = rows.withColumn("category_name", clean_category(F.col("category_name")))
    return rows.select(*names)


def bronze_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    age = (23 + key % 60).cast("int")

    def dollars(value: Column) -> Column:
        return F.concat(F.lit("$"), value.cast("decimal(18,2)").cast("string"))

    columns = {
        "id": key.cast("string"),
        "current_age": age,
        "retirement_age": (55 + F.col("c_nationkey") % 20).cast("int"),
        "birth_year": (2024 - age).cast("int"),
        "birth_month": (1 + key % 12).cast("int"),
        "gender": F.when(key % 2 == 0, "Female").otherwise("Male"),
        "address": F.col("c_name"),
        "latitude": (key % 90).cast("float"),
        "longitude": (-(key % 180)).cast("float"),
        "per_capita_income": dollars((key % 300) * 100),
        "yearly_income": dollars((F.col("c_acctbal") + 1000) * 5),
        "total_debt": dollars((key % 97) * 500),
        "credit_score": (488 + (key * 37) % 363).cast("int"),
        "num_credit_cards": (1 + key % 9).cast("int"),
    }
    customers = table(spark, sf_dir, "customer")
    return customers.select(*[columns[c].alias(c) for c in BRONZE_USERS.fieldNames()])


def silver_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_users(bronze_users(spark, sf_dir))
