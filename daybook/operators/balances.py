"""Opening balances and balances carried forward day by day."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions import Period, clip_to_period, days_of, money, valid_on
from daybook.functions.periods import ended_months_of
from daybook.operators.turnover import daily_rates
from daybook.schemas import ACTIVE, MONEY, PASSIVE, RATE


def _zero() -> Column:
    return F.lit(0).cast(MONEY)


def opening_balances(
    snapshot: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    period: Period,
) -> DataFrame:
    """Balances of the day before the period, for accounts valid on its first day.

    The ruble value uses the day-before rate of the currency the snapshot states,
    which may differ from the account's own.
    """
    day = period.day_before
    active = accounts.where(
        valid_on(period.start, "data_actual_date", "data_actual_end_date")
    ).select("account_rk")
    held = snapshot.where(F.col("on_date") == F.lit(day)).join(active, "account_rk")
    rated = held.join(daily_rates(rates, Period(day, day)), ["currency_rk", "on_date"], "left")
    balance = F.col("balance_out").cast(MONEY)
    return rated.select(
        "on_date",
        "account_rk",
        balance.alias("balance_out"),
        money(balance * F.coalesce("rate", F.lit(1).cast(RATE))).alias("balance_out_rub"),
    )


def _signed(char_type: Column, debet: str, credit: str) -> Column:
    net = F.coalesce(F.col(debet), _zero()) - F.coalesce(F.col(credit), _zero())
    return (
        F.when(char_type == F.lit(ACTIVE), net)
        .when(char_type == F.lit(PASSIVE), -net)
        .otherwise(_zero())
    )


def balances(
    accounts: DataFrame,
    turnover: DataFrame,
    opening: DataFrame,
    period: Period,
    days: Literal["all", "month_ends"] = "all",
) -> DataFrame:
    """Balance mart: one row per account and day on which the account is valid.

    Balance of a day = balance of the day before, plus debit less credit for
    active accounts, minus for passive ones, unchanged for others. An account not
    valid on a day starts again from zero; ``opening`` (rows of the day before
    the period) counts only for accounts valid on the first day. Ruble balances
    are carried, not revalued.

    The chain is a running sum over an account's *movements* only: an account has
    at most one row per day of the period there, whatever its share of the
    postings. Quiet days are filled in at the very end, row by row, so the
    shuffle and the sort never see accounts x days. ``days="month_ends"`` fills in
    only the last days of months.

    Versions of one account must not overlap, and ``turnover`` and ``opening``
    must hold one row per account (and day); the job raises otherwise.
    """
    versions = clip_to_period(
        accounts, period, "data_actual_date", "data_actual_end_date"
    ).select("account_rk", "char_type", "data_actual_date", "valid_from", "valid_to")
    seeds = opening.where(F.col("on_date") == F.lit(period.day_before)).select(
        "account_rk",
        F.col("balance_out").alias("seed"),
        F.col("balance_out_rub").alias("seed_rub"),
    )
    moves = turnover.where(period.contains("on_date"))
    moved = (
        versions.join(seeds, "account_rk", "left")
        .alias("v")
        .join(
            moves.alias("t"),
            (F.col("v.account_rk") == F.col("t.account_rk"))
            & valid_on("t.on_date", "v.valid_from", "v.valid_to"),
            "left",
        )
        .select(
            "v.account_rk",
            "v.data_actual_date",
            "v.valid_from",
            "v.valid_to",
            F.col("t.on_date").alias("moved_on"),
            _signed(F.col("v.char_type"), "t.debet_amount", "t.credit_amount").alias("move"),
            _signed(
                F.col("v.char_type"), "t.debet_amount_rub", "t.credit_amount_rub"
            ).alias("move_rub"),
            F.when(F.col("v.valid_from") == F.lit(period.start), F.col("v.seed")).alias("seed"),
            F.when(F.col("v.valid_from") == F.lit(period.start), F.col("v.seed_rub")).alias(
                "seed_rub"
            ),
        )
    )

    in_order = Window.partitionBy("account_rk").orderBy("data_actual_date", "moved_on")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous_start = F.lag("data_actual_date").over(in_order)
    previous_end = F.lag("valid_to").over(in_order)
    previous_move = F.lag("moved_on").over(in_order)
    first_of_version = previous_start.isNull() | (previous_start != F.col("data_actual_date"))
    follows = (
        previous_start.isNull()
        | (previous_end < F.col("valid_from"))
        | ((previous_start == F.col("data_actual_date")) & (previous_move < F.col("moved_on")))
    )
    chained = moved.select(
        "*",
        first_of_version.alias("opens"),
        # First row after a gap (or at all): nothing is carried into it.
        (previous_end.isNull() | (previous_end < F.date_sub("valid_from", 1))).alias("restarts"),
        F.coalesce(follows, F.lit(False)).alias("in_sequence"),
        F.when(
            F.lead("data_actual_date").over(in_order) == F.col("data_actual_date"),
            F.date_sub(F.lead("moved_on").over(in_order), 1),
        ).alias("until"),
        F.sum("move").over(so_far).alias("total"),
        F.sum("move_rub").over(so_far).alias("total_rub"),
    )

    # What to add to the sum since a restart: the opening balance, less all that
    # was summed up before.
    def carried_from_restart(total: str, move: str, seed: str) -> Column:
        offset = F.coalesce(F.col(seed), _zero()) - (F.col(total) - F.col(move))
        return F.col(total) + F.last(
            F.when(F.col("restarts"), offset), ignorenulls=True
        ).over(so_far)

    after = carried_from_restart("total", "move", "seed")
    after_rub = carried_from_restart("total_rub", "move_rub", "seed_rub")
    problem = F.concat(
        F.lit("overlapping versions or repeated rows for account "),
        F.col("account_rk").cast("string"),
    )
    stretches = chained.select(
        "account_rk",
        "moved_on",
        F.when(~F.col("in_sequence"), F.raise_error(problem).cast("date"))
        .when(F.col("opens"), F.col("valid_from"))
        .otherwise(F.col("moved_on"))
        .alias("first_day"),
        F.coalesce("until", "valid_to").alias("last_day"),
        money(after).alias("after"),
        money(after_rub).alias("after_rub"),
        money(after - F.col("move")).alias("before"),
        money(after_rub - F.col("move_rub")).alias("before_rub"),
    )
    if days == "all":
        on_days = stretches.withColumn(
            "on_date", F.explode(days_of(F.col("first_day"), F.col("last_day")))
        )
    else:
        on_days = stretches.withColumn(
            "month", F.explode(ended_months_of(F.col("first_day"), F.col("last_day")))
        ).withColumn("on_date", F.last_day("month"))
    # Only a version's first stretch can begin before its first movement.
    not_yet = F.coalesce(F.col("on_date") < F.col("moved_on"), F.lit(False))
    return on_days.select(
        "on_date",
        "account_rk",
        F.when(not_yet, F.col("before")).otherwise(F.col("after")).alias("balance_out"),
        F.when(not_yet, F.col("before_rub")).otherwise(F.col("after_rub")).alias(
            "balance_out_rub"
        ),
    )
