"""Readers and writers."""

from spendlake.sources.files import (
    read_inferred_csv,
    read_mcc_json,
    read_transaction_lines,
    read_transactions_csv,
    read_user_lines,
    read_users_csv,
    strict_csv_options,
)
from spendlake.sources.lake import (
    look_up,
    read_table,
    read_table_or_empty,
    table_exists,
    write_clustered,
    write_table,
)
from spendlake.sources.literals import asset_table, card_product_table, guest_request, rows_table

__all__ = [
    "asset_table",
    "card_product_table",
    "guest_request",
    "look_up",
    "read_inferred_csv",
    "read_mcc_json",
    "read_table",
    "read_table_or_empty",
    "read_transaction_lines",
    "read_transactions_csv",
    "read_user_lines",
    "read_users_csv",
    "rows_table",
    "strict_csv_options",
    "table_exists",
    "write_clustered",
    "write_table",
]
