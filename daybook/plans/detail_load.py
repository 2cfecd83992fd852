"""Raw text files to the typed detail layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import parse_date, parse_integer, parse_key, parse_number
from daybook.operators.maintain import upsert
from daybook.schemas import (
    FT_BALANCE,
    FT_POSTING,
    LEDGER_LOADED,
    MD_ACCOUNT,
    MD_CURRENCY,
    MD_EXCHANGE_RATE,
    MD_LEDGER_ACCOUNT,
    RATE,
)
from daybook.sources.writers import merge_days, write_by_day

# Column names of the files are those of the tables in capitals; Spark matches
# names without regard to case.


def typed_accounts(raw: DataFrame) -> DataFrame:
    return raw.select(
        parse_date("data_actual_date").alias("data_actual_date"),
        parse_date("data_actual_end_date").alias("data_actual_end_date"),
        parse_key("account_rk").alias("account_rk"),
        F.col("account_number").alias("account_number"),
        F.col("char_type").alias("char_type"),
        parse_key("currency_rk").alias("currency_rk"),
        F.col("currency_code").alias("currency_code"),
    )


def typed_currencies(raw: DataFrame) -> DataFrame:
    return raw.select(
        parse_key("currency_rk").alias("currency_rk"),
        parse_date("data_actual_date").alias("data_actual_date"),
        parse_date("data_actual_end_date").alias("data_actual_end_date"),
        F.col("currency_code").alias("currency_code"),
        F.col("code_iso_char").alias("code_iso_char"),
    )


def typed_rates(raw: DataFrame) -> DataFrame:
    return raw.select(
        parse_date("data_actual_date").alias("data_actual_date"),
        parse_date("data_actual_end_date").alias("data_actual_end_date"),
        parse_key("currency_rk").alias("currency_rk"),
        parse_number("reduced_cource", RATE).alias("reduced_cource"),
        F.col("code_iso_num").alias("code_iso_num"),
    )


def typed_ledger(raw: DataFrame) -> DataFrame:
    """The loaded part of the ledger plan; the other columns are not in the file."""
    numbers = {"section_number": 3, "ledger1_account": 3, "ledger_account": 5}
    return raw.select(
        *[
            parse_integer(name, numbers[name]).alias(name)
            if name in numbers
            else parse_date(name).alias(name)
            if name in MD_LEDGER_ACCOUNT.interval
            else F.col(name).alias(name)
            for name in LEDGER_LOADED
        ]
    )


def typed_balances(raw: DataFrame) -> DataFrame:
    return raw.select(
        parse_date("on_date", "dd.MM.yyyy").alias("on_date"),
        parse_key("account_rk").alias("account_rk"),
        parse_key("currency_rk").alias("currency_rk"),
        parse_number("balance_out").alias("balance_out"),
    )


def typed_postings(raw: DataFrame) -> DataFrame:
    return raw.select(
        parse_date("oper_date", "dd-MM-yyyy").alias("oper_date"),
        parse_key("credit_account_rk").alias("credit_account_rk"),
        parse_key("debet_account_rk").alias("debet_account_rk"),
        parse_number("credit_amount").alias("credit_amount"),
        parse_number("debet_amount").alias("debet_amount"),
    )


def load_facts(raw: Mapping[str, DataFrame], folder: str) -> None:
    """Raw balances and postings into fact tables stored by day below ``folder``.

    Balances are merged by key: only the days a delivery names are read and rewritten.
    Postings have no key; a delivery of them replaces the table. Both are written in whole
    days, so that a month close reads the files of its month only. What ``raw`` lacks
    stays as it is.
    """
    if FT_BALANCE.name in raw:
        merge_days(
            typed_balances(raw[FT_BALANCE.name]),
            f"{folder}/{FT_BALANCE.name}",
            FT_BALANCE.key,
            schema=FT_BALANCE.schema,
        )
    if FT_POSTING.name in raw:
        write_by_day(
            typed_postings(raw[FT_POSTING.name]), f"{folder}/{FT_POSTING.name}", "oper_date"
        )


def load_dimensions(
    raw: Mapping[str, DataFrame], current: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """New contents of the dimension tables from raw text and current contents."""

    def merged(table, typed, columns=None):
        return upsert(current[table.name], typed(raw[table.name]), table.key, columns)

    return {
        MD_ACCOUNT.name: merged(MD_ACCOUNT, typed_accounts),
        MD_CURRENCY.name: merged(MD_CURRENCY, typed_currencies),
        MD_EXCHANGE_RATE.name: merged(MD_EXCHANGE_RATE, typed_rates),
        MD_LEDGER_ACCOUNT.name: merged(MD_LEDGER_ACCOUNT, typed_ledger, LEDGER_LOADED),
    }


def load_detail(
    raw: Mapping[str, DataFrame], current: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """New contents of the six detail tables from raw text and current contents.

    Dimensions and balances are merged by key; postings are replaced as a whole.
    Keys of both mappings are the table names. Where facts are stored by day,
    ``load_facts`` rewrites only the days delivered.
    """
    balances = upsert(
        current[FT_BALANCE.name], typed_balances(raw[FT_BALANCE.name]), FT_BALANCE.key
    )
    return load_dimensions(raw, current) | {
        FT_BALANCE.name: balances,
        FT_POSTING.name: typed_postings(raw[FT_POSTING.name]),
    }
