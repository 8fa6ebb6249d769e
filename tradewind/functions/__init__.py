"""Column expressions shared by the operators and the report plans."""

from .bands import band, pick
from .dates import as_date, days_between, in_year, month_label, month_start, on_or_after, year_before_last
from .money import cents, merge_cents, sum_cents, to_amount
from .ratios import percent, ratio
from .sql import register_sql_functions

__all__ = [
    "as_date",
    "band",
    "cents",
    "days_between",
    "in_year",
    "merge_cents",
    "month_label",
    "month_start",
    "on_or_after",
    "percent",
    "pick",
    "ratio",
    "register_sql_functions",
    "sum_cents",
    "to_amount",
    "year_before_last",
]
