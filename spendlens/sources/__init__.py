"""Readers for the driver tables, the expense-shaped views and raw expense files."""

from spendlens.sources.tables import read_table
from spendlens.sources.views import expense_view_d, expense_view_l, raw_view

__all__ = ["read_table", "expense_view_d", "expense_view_l", "raw_view"]
