"""Loan-holiday mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.lookup import left_join_skewed
from daybook.operators.maintain import dedupe
from daybook.schemas import LOAN_HOLIDAY, LOAN_HOLIDAY_MART_COLUMNS


def loan_holiday_mart(
    deals: DataFrame,
    holidays: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Every deal version with its loan holiday and its product's name.

    A holiday belongs to the deal version that begins on the same day; the mart's
    validity dates are the holiday's and NULL without one. The product name
    counts only if it equals the deal's name. Versions of a product that differ
    only in their end repeat the deal.
    """
    names = (
        dedupe(
            products.select("product_rk", "product_name", "effective_from_date", "effective_to_date")
        ).select(
            "product_rk",
            F.col("effective_from_date").alias("deal_from"),
            "product_name",
            F.col("product_name").alias("deal_name"),
        )
    )
    deals = deals.select(
        "deal_rk",
        F.col("effective_from_date").alias("deal_from"),
        F.col("deal_num").alias("deal_number"),
        "deal_name",
        "deal_sum",
        "account_rk",
        "client_rk",
        "agreement_rk",
        "deal_start_date",
        "department_rk",
        "product_rk",
        "deal_type_cd",
    )
    # Never sent whole: Spark takes versions that are made on reading for less than they are.
    named = deals.join(names.hint("merge"), ["product_rk", "deal_from", "deal_name"], "left")
    periods = holidays.select(
        *LOAN_HOLIDAY.columns, F.col("effective_from_date").alias("deal_from")
    )
    return left_join_skewed(named, periods, ["deal_rk", "deal_from"]).select(
        *LOAN_HOLIDAY_MART_COLUMNS
    )
