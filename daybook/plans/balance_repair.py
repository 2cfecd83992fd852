"""Repair of opening sums, then the account balance and turnover mart."""

from __future__ import annotations

from pyspark.sql import DataFrame

from daybook.operators.continuity import account_balance_turnover, repair_in_sums


def repair_and_publish(
    accounts: DataFrame, balances: DataFrame, currencies: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Balances with opening sums corrected, and the mart built from them."""
    repaired = repair_in_sums(balances)
    return repaired, account_balance_turnover(accounts, repaired, currencies)
