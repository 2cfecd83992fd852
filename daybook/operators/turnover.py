"""Daily account turnover from two-sided postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import Period, clip_to_period, days_of, money, valid_on
from daybook.operators.parts import in_parts, row_part
from daybook.schemas import DM_TURNOVER, MONEY, RATE


def daily_rates(rates: DataFrame, period: Period) -> DataFrame:
    """One row per currency and day of the period: on_date, currency_rk, rate.

    Turning the validity interval into days makes the rate join a plain equality
    on (currency, day). The size is currencies x days of the period.
    """
    clipped = clip_to_period(rates, period, "data_actual_date", "data_actual_end_date")
    return clipped.select(
        F.explode(days_of(F.col("valid_from"), F.col("valid_to"))).alias("on_date"),
        "currency_rk",
        F.col("reduced_cource").cast(RATE).alias("rate"),
    )


def _leg(side: str) -> Column:
    """One side of a posting, with the columns of both sides."""

    def amount(of: str) -> Column:
        value = F.col(f"{of}_amount") if of == side else F.lit(None)
        return value.cast(MONEY).alias(f"{of}_amount")

    return F.struct(
        F.col(f"{side}_account_rk").alias("account_rk"),
        amount("credit"),
        amount("debet"),
        F.lit(int(side == "credit")).alias("credit_legs"),
        F.lit(int(side == "debet")).alias("debet_legs"),
    )


def posting_legs(postings: DataFrame, period: Period) -> DataFrame:
    """Amounts of the period per day and account, one column per side.

    Postings are read once and dealt over parts whole, so an account with a large share
    of them is reduced to one row per day in every part. What is left meets by account,
    and the result stays in parts of the account. However many postings a file
    holds, no task adds up more than its part.
    """
    held = postings.where(period.contains("oper_date")).select(
        "oper_date", *[f"{side}_{c}" for side in ("credit", "debet") for c in ("account_rk", "amount")]
    )
    legs = in_parts(held.withColumn("part", row_part(held)), "part").select(
        "part", F.col("oper_date").alias("on_date"), F.inline(F.array(_leg("credit"), _leg("debet")))
    )
    sums = ["credit_amount", "debet_amount", "credit_legs", "debet_legs"]
    by_part = legs.groupBy("part", "on_date", "account_rk").agg(*[F.sum(c).alias(c) for c in sums])
    return (
        in_parts(by_part.drop("part"), "account_rk")
        .groupBy("on_date", "account_rk")
        .agg(
            money(F.sum("credit_amount")).alias("credit_amount"),
            money(F.sum("debet_amount")).alias("debet_amount"),
            F.sum("credit_legs").alias("credit_legs"),
            F.sum("debet_legs").alias("debet_legs"),
        )
    )


def _versions(accounts: DataFrame, period: Period) -> DataFrame:
    return clip_to_period(
        accounts, period, "data_actual_date", "data_actual_end_date"
    ).select("account_rk", "currency_rk", "valid_from", "valid_to")


def turnover(
    postings: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    period: Period,
) -> DataFrame:
    """Turnover mart for every day of the period, in account currency and rubles.

    A leg whose account is not valid on the posting day is left out; the other
    leg of the posting stays. A currency without a rate on the day counts one to
    one. A side without postings is NULL. The ruble amount is rounded once, after
    the day's sum: the rate is the same for all of an account's postings of one
    day, so summing first and multiplying once gives the same exact number.
    """
    legs = posting_legs(postings, period).drop("credit_legs", "debet_legs")
    valid = (
        legs.join(_versions(accounts, period), "account_rk")
        .where(valid_on("on_date", "valid_from", "valid_to"))
        .drop("valid_from", "valid_to")
    )
    # No hint: Spark broadcasts the rates if they are small, and else splits the ruble's rows.
    rated = valid.join(daily_rates(rates, period), ["currency_rk", "on_date"], "left")
    rate = F.coalesce("rate", F.lit(1).cast(RATE))
    # One row per account and day already, unless versions or rates overlap.
    return (
        rated.groupBy("account_rk", "on_date")
        .agg(
            money(F.sum("credit_amount")).alias("credit_amount"),
            money(F.sum(F.col("credit_amount") * rate)).alias("credit_amount_rub"),
            money(F.sum("debet_amount")).alias("debet_amount"),
            money(F.sum(F.col("debet_amount") * rate)).alias("debet_amount_rub"),
        )
        .select(DM_TURNOVER.columns)
    )


def dropped_legs(postings: DataFrame, accounts: DataFrame, period: Period) -> DataFrame:
    """What turnover leaves out: per day, the legs whose account is not valid then."""
    versions = _versions(accounts, period).withColumnRenamed("account_rk", "version_rk")
    legs = posting_legs(postings, period)
    covered = (F.col("account_rk") == F.col("version_rk")) & valid_on(
        "on_date", "valid_from", "valid_to"
    )
    return (
        legs.join(versions, covered, "left_anti")
        .groupBy("on_date")
        .agg(
            F.sum("credit_legs").alias("credit_legs"),
            F.sum("debet_legs").alias("debet_legs"),
            money(F.sum("credit_amount")).alias("credit_amount"),
            money(F.sum("debet_amount")).alias("debet_amount"),
        )
    )
