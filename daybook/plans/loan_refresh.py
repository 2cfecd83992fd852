"""Refresh of products and deals, then the loan-holiday mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from daybook.operators.loans import loan_holiday_mart
from daybook.operators.maintain import append_new, dedupe


def refresh_loans(
    new_products: DataFrame,
    new_deals: DataFrame,
    deals: DataFrame,
    holidays: DataFrame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Products replaced without copies, deals extended by the new ones, and the
    mart built from both."""
    products = dedupe(new_products)
    deals = append_new(deals, new_deals)
    return products, deals, loan_holiday_mart(deals, holidays, products)
