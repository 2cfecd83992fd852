"""Continuity of periodic balances: each opening sum equals the last closing sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


# Fixed value: the currency name of accounts whose currency is not listed.
NO_CURRENCY = "-1"


def _by_date() -> WindowSpec:
    # An account has one row per date, so a window partition is bounded by the
    # number of dates whatever the size of the table; repeated dates raise.
    return Window.partitionBy("account_rk").orderBy("effective_date")


def _corrected(balances: DataFrame, column: str, expected: Column) -> Column:
    repeated = F.lag("effective_date").over(_by_date()) == F.col("effective_date")
    problem = F.concat(
        F.lit("repeated effective_date for account "), F.col("account_rk").cast("string")
    )
    kind = balances.schema[column].dataType
    return (
        F.when(repeated, F.raise_error(problem).cast(kind))
        .when(F.col(column) != expected, expected)
        .otherwise(F.col(column))
    )


def in_sum_corrections(balances: DataFrame) -> DataFrame:
    """Add ``correct_account_in_sum``: the account's previous closing sum where the
    opening sum differs from it. The first row of an account and rows with a NULL
    on either side keep their value. Corrections start from the stored values and
    do not build on each other."""
    expected = F.lag("account_out_sum").over(_by_date())
    return balances.withColumn(
        "correct_account_in_sum", _corrected(balances, "account_in_sum", expected)
    )


def out_sum_corrections(balances: DataFrame) -> DataFrame:
    """Add ``correct_account_out_sum``: the account's next opening sum where the
    closing sum differs from it."""
    expected = F.lead("account_in_sum").over(_by_date())
    return balances.withColumn(
        "correct_account_out_sum", _corrected(balances, "account_out_sum", expected)
    )


def repair_in_sums(balances: DataFrame) -> DataFrame:
    """The balances with opening sums corrected."""
    corrected = in_sum_corrections(balances)
    return corrected.withColumn("account_in_sum", F.col("correct_account_in_sum")).select(
        balances.columns
    )


def preview(df: DataFrame, order: Sequence[str], rows: int = 40) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*order).limit(rows)


def account_balance_turnover(
    accounts: DataFrame,
    balances: DataFrame,
    currencies: DataFrame,
) -> DataFrame:
    """Every account with its balances by date and its currency's name.

    Accounts without balances appear once with NULLs. The currency is looked up
    per account, before balances multiply the rows.
    """
    named = accounts.select("account_rk", "department_rk", "currency_cd").join(
        currencies.select("currency_cd", "currency_name"), "currency_cd", "left"
    )
    return named.join(balances, "account_rk", "left").select(
        "account_rk",
        F.coalesce("currency_name", F.lit(NO_CURRENCY)).alias("currency_name"),
        "department_rk",
        "effective_date",
        "account_in_sum",
        "account_out_sum",
    )
