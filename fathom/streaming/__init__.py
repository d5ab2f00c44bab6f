"""Structured Streaming versions of the ledger aggregations."""

from fathom.streaming.balance import advance, late_moves, start_running_balance
from fathom.streaming.ledger import cash_moves, daily_ledger, dropped_as_late, start_daily_ledger, table_stream

__all__ = [
    "advance", "cash_moves", "daily_ledger", "dropped_as_late", "late_moves",
    "start_daily_ledger", "start_running_balance", "table_stream",
]
