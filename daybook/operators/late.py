"""Corrections of closed days from postings that arrive after the close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions import Period, clip_to_period, money, valid_on
from daybook.operators.parts import in_parts
from daybook.operators.turnover import daily_rates, posting_legs
from daybook.schemas import ACTIVE, DM_BALANCE, DM_TURNOVER, MONEY, PASSIVE, RATE

AMOUNTS = ("credit_amount", "debet_amount")


def _zero() -> Column:
    return F.lit(0).cast(MONEY)


def _chains(accounts: DataFrame, period: Period) -> DataFrame:
    """Versions with ``chain_end``, the last day before the account's next gap.

    A window partition holds an account's versions. Versions that adjoin are one chain:
    a balance is carried from one into the next, also when the type changes.
    """
    versions = clip_to_period(accounts, period, "data_actual_date", "data_actual_end_date")
    in_order = Window.partitionBy("account_rk").orderBy("valid_from")
    opens = F.coalesce(
        F.lag("valid_to").over(in_order) < F.date_sub("valid_from", 1), F.lit(True)
    )
    numbered = versions.withColumn("opens", opens.cast("int")).withColumn(
        "chain", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.select(
        "account_rk",
        "currency_rk",
        "char_type",
        "valid_from",
        "valid_to",
        F.max("valid_to").over(Window.partitionBy("account_rk", "chain")).alias("chain_end"),
    )


def late_turnover(
    late: DataFrame,
    stored: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    period: Period,
) -> DataFrame:
    """The turnover rows that late postings change, with what they change.

    Columns of the turnover mart, then ``move`` and ``move_rub``: what the row's
    balance moves by on its day and all days up to ``chain_end``, the last day before
    the account's next gap.

    ``stored`` is the mart as closed over ``period``; only rows of the days and accounts
    of late postings are read from it. Ruble amounts are rounded once, after the
    whole day's sum, so the rows are those of a close with all postings. Late
    legs of accounts not valid on their day are left out, as the close leaves them out.
    The result is in parts of day and account, where it can be merged into the mart.
    """
    legs = posting_legs(late, period).drop("credit_legs", "debet_legs")
    valid = (
        legs.join(_chains(accounts, period), "account_rk")
        .where(valid_on("on_date", "valid_from", "valid_to"))
        .join(daily_rates(rates, period), ["currency_rk", "on_date"], "left")
    )
    held = stored.where(period.contains("on_date")).select(
        "on_date",
        "account_rk",
        *[F.col(c).alias(f"old_{c}") for a in AMOUNTS for c in (a, f"{a}_rub")],
    )
    key = ["on_date", "account_rk"]
    met = in_parts(valid, *key).join(in_parts(held, *key), key, "left")
    rate = F.coalesce("rate", F.lit(1).cast(RATE))

    def whole(amount: str) -> Column:
        # A side without postings, on time or late, stays NULL.
        both = F.coalesce(f"old_{amount}", _zero()) + F.coalesce(amount, _zero())
        given = F.col(f"old_{amount}").isNotNull() | F.col(amount).isNotNull()
        return F.when(given, money(both))

    new = met.select(
        "on_date",
        "account_rk",
        "char_type",
        "chain_end",
        *[c for c in met.columns if c.startswith("old_")],
        *[whole(a).alias(a) for a in AMOUNTS],
        rate.alias("rate"),
    )
    for a in AMOUNTS:
        new = new.withColumn(f"{a}_rub", money(F.col(a) * F.col("rate")))

    def move(debet: str, credit: str) -> Column:
        def more(c: str) -> Column:
            return F.coalesce(c, _zero()) - F.coalesce(f"old_{c}", _zero())

        net = more(debet) - more(credit)
        kind = F.col("char_type")
        return money(
            F.when(kind == F.lit(ACTIVE), net).when(kind == F.lit(PASSIVE), -net).otherwise(_zero())
        )

    return new.select(
        *DM_TURNOVER.columns,
        move("debet_amount", "credit_amount").alias("move"),
        move("debet_amount_rub", "credit_amount_rub").alias("move_rub"),
        "chain_end",
    )


def late_balances(changed: DataFrame, stored: DataFrame, period: Period) -> DataFrame:
    """The stored balance rows that ``changed`` (see ``late_turnover``) moves, as they
    have to be.

    An account's moves are added up in order of days within a chain; each sum
    holds from its day to the day before the next, at last to the chain's end. Stored
    rows meet these stretches by account: the work follows the touched accounts'
    days, whatever the mart holds of others. Rows that stay the same are left out.
    Moves are brought into parts of the account before they are added up, and stay there.
    """
    in_chain = Window.partitionBy("account_rk", "chain_end").orderBy("on_date")
    so_far = in_chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stretches = in_parts(changed, "account_rk").select(
        "account_rk",
        F.col("on_date").alias("first_day"),
        F.coalesce(F.date_sub(F.lead("on_date").over(in_chain), 1), "chain_end").alias("last_day"),
        money(F.sum("move").over(so_far)).alias("move"),
        money(F.sum("move_rub").over(so_far)).alias("move_rub"),
    ).where((F.col("move") != 0) | (F.col("move_rub") != 0))
    return (
        stored.where(period.contains("on_date"))
        .join(stretches, "account_rk")
        .where(F.col("on_date").between(F.col("first_day"), F.col("last_day")))
        .select(
            "on_date",
            "account_rk",
            money(F.col("balance_out") + F.col("move")).alias("balance_out"),
            money(F.col("balance_out_rub") + F.col("move_rub")).alias("balance_out_rub"),
        )
        .select(DM_BALANCE.columns)
    )
