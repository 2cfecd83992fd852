"""Short ways to make the small tables of the tests."""

from datetime import date
from decimal import Decimal

from daybook.schemas import (
    DM_BALANCE,
    FT_BALANCE,
    FT_POSTING,
    MD_ACCOUNT,
    MD_EXCHANGE_RATE,
    MD_LEDGER_ACCOUNT,
)

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
JAN = (date(2018, 1, 1), date(2018, 1, 31))
A, P = "А", "П"


def day(number, month=1, year=2018):
    return date(year, month, number)


def num(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("1e-8"))


def accounts(spark, *rows):
    """(account, type, from, to[, currency[, code[, number]]])"""
    full = []
    for row in rows:
        rk, kind, start, end, *rest = row
        currency = rest[0] if rest else 34
        code = rest[1] if len(rest) > 1 else "810"
        number = rest[2] if len(rest) > 2 else f"30102{rk:015d}"
        full.append((start, end, rk, number, kind, currency, code))
    return spark.createDataFrame(full, MD_ACCOUNT.schema)


def postings(spark, *rows):
    """(day, credit account, debit account, credit amount, debit amount)"""
    return spark.createDataFrame(
        [(d, c, b, num(x), num(y)) for d, c, b, x, y in rows], FT_POSTING.schema
    )


def rates(spark, *rows):
    """(currency, from, to, rate)"""
    return spark.createDataFrame(
        [(start, end, rk, num(rate), "000") for rk, start, end, rate in rows],
        MD_EXCHANGE_RATE.schema,
    )


def snapshot(spark, *rows):
    """(day, account, currency, balance)"""
    return spark.createDataFrame(
        [(d, rk, currency, num(x)) for d, rk, currency, x in rows], FT_BALANCE.schema
    )


def mart(spark, *rows):
    """(day, account, balance, balance in rubles)"""
    return spark.createDataFrame(
        [(d, rk, num(x), num(y)) for d, rk, x, y in rows], DM_BALANCE.schema
    )


def ledger(spark, *rows):
    """(ledger account, chapter, from, to)"""
    names = MD_LEDGER_ACCOUNT.columns
    full = []
    for code, chapter, start, end in rows:
        row = dict.fromkeys(names)
        row.update(ledger_account=code, chapter=chapter, start_date=start, end_date=end)
        full.append(tuple(row[n] for n in names))
    return spark.createDataFrame(full, MD_LEDGER_ACCOUNT.schema)


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
