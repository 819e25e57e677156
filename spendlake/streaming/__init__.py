"""Streaming forms of the batch stages."""

from spendlake.streaming.distinct import distinct_within, stream_distinct_transactions
from spendlake.streaming.rollup import RollupTables, add_batch, stream_client_months
from spendlake.streaming.silver import stream_silver_transactions

__all__ = [
    "RollupTables", "add_batch", "distinct_within", "stream_client_months", "stream_distinct_transactions",
    "stream_silver_transactions",
]
