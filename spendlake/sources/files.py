"""Raw CSV and JSON files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.schemas import BRONZE_TRANSACTIONS, BRONZE_USERS

# What a whole number looks like to the CSV parser, which unlike a cast accepts no outer spaces.
_INTEGER_TEXT = r"^[+-]?[0-9]+$"


def strict_csv_options(check_header: bool = True) -> dict[str, str]:
    """Options under which a row counts as malformed whichever columns a query selects.

    With column pruning on, the parser skips unselected columns, so ``count()`` would keep rows
    that a full read drops. ``enforceSchema=false`` makes a header that does not match the schema
    an error; otherwise columns bind by position and a reordered file is misread silently.
    """
    return {
        "header": "true",
        "mode": "DROPMALFORMED",
        "columnPruning": "false",
        "enforceSchema": "false" if check_header else "true",
    }


#: Holds the whole line where it has too few or too many fields.
MALFORMED = "_malformed"


def _all_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _parses(field: T.StructField) -> Column:
    column = F.col(field.name)
    ok = column.try_cast(field.dataType).isNotNull()
    if isinstance(field.dataType, T.IntegerType):
        ok = ok & column.rlike(_INTEGER_TEXT)
    return column.isNull() | ok


def drop_mistyped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Type an all-text frame, keeping only rows in which every typed column parses."""
    typed = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    if typed:
        df = df.filter(reduce(lambda a, b: a & b, [_parses(f) for f in typed]))
    return df.select(
        *[
            F.col(f.name) if f not in typed else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def _read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, check_header: bool
) -> DataFrame:
    reader = spark.read.options(**strict_csv_options(check_header)).schema(_all_text(schema))
    return drop_mistyped(reader.csv(path), schema)


def read_transactions_csv(
    spark: SparkSession, path: str | list[str], check_header: bool = True
) -> DataFrame:
    """Raw card transactions; ``path`` may be a file, a folder, a glob or a list of them."""
    return _read_csv(spark, path, BRONZE_TRANSACTIONS, check_header)


def read_users_csv(
    spark: SparkSession, path: str | list[str], check_header: bool = True
) -> DataFrame:
    """Raw users; money columns stay text here."""
    return _read_csv(spark, path, BRONZE_USERS, check_header)


def _read_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, check_header: bool
) -> DataFrame:
    options = {**strict_csv_options(check_header), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    return spark.read.options(**options).schema(_all_text(schema).add(MALFORMED, "string")).csv(path)


def read_transaction_lines(
    spark: SparkSession, path: str | list[str], check_header: bool = True
) -> DataFrame:
    """All lines of raw transactions, as text; those that do not fit the schema are in :data:`MALFORMED`."""
    return _read_lines(spark, path, BRONZE_TRANSACTIONS, check_header)


def read_user_lines(spark: SparkSession, path: str | list[str], check_header: bool = True) -> DataFrame:
    """All lines of raw users, as text; those that do not fit the schema are in :data:`MALFORMED`."""
    return _read_lines(spark, path, BRONZE_USERS, check_header)


def typed_or_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Type the columns of an all-text frame; adds ``mistyped``, the first column that does not parse, or null."""
    typed = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    first = F.coalesce(*[F.when(~_parses(f), F.lit(f.name)) for f in typed], F.lit(None).cast("string"))
    return df.withColumn("mistyped", first).withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in typed})


def read_mcc_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(mcc, category_name)`` from one flat JSON object ``{"5812": "Restaurants", ...}``.

    Read as a map, so there is no inference pass with one column per code, and codes may contain
    dots. A code given twice keeps its last name, so the join on it can never multiply rows. A file
    that is no JSON object fails the job: no rows would turn every category into an unknown one.
    """
    codes = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    unreadable = F.raise_error(F.lit(f"no JSON object of category codes: {path}"))
    entries = (
        spark.read.text(path, wholetext=True)
        .agg(F.max("value").alias("value"))  # one row, also of an empty file
        .select(F.coalesce(codes, unreadable.cast("map<string,string>")).alias("codes"))
        .select(F.posexplode("codes").alias("position", "mcc", "category_name"))
    )
    return entries.groupBy("mcc").agg(
        F.max_by("category_name", "position").alias("category_name")
    )


def read_inferred_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header and inferred types. Inference is a second pass over the files."""
    return spark.read.csv(path, header=True, inferSchema=True)
