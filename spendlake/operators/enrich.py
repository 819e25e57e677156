"""Joins of transactions with their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Category codes have four digits, so a real dictionary has at most this many rows.
MAX_CATEGORY_ROWS = 10_000
MAX_CATEGORY_BYTES = 8 << 20
SALTS = 32


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_CATEGORY_ROWS, max_bytes: int = MAX_CATEGORY_BYTES
) -> bool:
    """Whether ``df`` is small, found by reading at most ``max_rows + 1`` of its rows."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    size = (
        df.select(width.alias("width"))
        .limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("width").alias("bytes"))
        .first()
    )
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, salt_by: str, salts: int = SALTS
) -> DataFrame:
    """Left join on ``key`` in which the rows of one key value go to up to ``salts`` tasks.

    The salt hashes ``salt_by``, a column that differs between rows of one key, so a retried task
    computes the same one. The right side is repeated once per salt.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("shuffle_hash"), [key, "_salt"], "left").drop("_salt")


def add_category(
    transactions: DataFrame, categories: DataFrame, small: bool | None = None
) -> DataFrame:
    """Left join with ``(mcc, category_name)``; transactions with an unknown code stay.

    A dictionary of checked size is broadcast, so the transactions are not shuffled at all. A
    larger one is joined by a salted shuffle, because a few codes hold most transactions. Pass
    ``small`` where the size is already known.
    """
    if small is None:
        small = fits_broadcast(categories)
    if small:
        return transactions.join(F.broadcast(categories), "mcc", "left")
    return salted_left_join(transactions, categories, "mcc", salt_by="id")


def add_users(transactions: DataFrame, users: DataFrame, salts: int | None = None) -> DataFrame:
    """Every transaction with the columns of its user; ``id`` becomes ``transaction_id``.

    Both sides grow with the data, so nothing is broadcast. The users of a task are hashed, so that the
    wide transactions need no sort, which would spill them. By default AQE splits the
    tasks of a hot client; ``salts`` spreads all clients up front, for a cluster without AQE.
    """
    left = transactions.withColumnRenamed("id", "transaction_id")
    right = users.withColumnRenamed("id", "client_id")
    if salts is None:
        return left.join(right.hint("shuffle_hash"), "client_id", "left").select(
            *left.columns, *[c for c in right.columns if c != "client_id"]
        )
    joined = salted_left_join(left, right, "client_id", salt_by="transaction_id", salts=salts)
    return joined.select(*left.columns, *[c for c in right.columns if c != "client_id"])
