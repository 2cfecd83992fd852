"""Form 101: balances and turnover of a month by ledger account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import Period, clip_to_period, fixed_scale_text, money, whole_months_of
from daybook.schemas import DM_FORM101, FORM101_MEASURES, MONEY, RUBLE_CODES

_HEAD = ["from_date", "to_date", "chapter", "ledger_account", "characteristic"]


def form101(
    accounts: DataFrame,
    ledger: DataFrame,
    turnover: DataFrame,
    balances: DataFrame,
    period: Period,
) -> DataFrame:
    """The report for every whole month of the period, usually one.

    Accounts and ledger accounts take part in a month they are valid on every day
    of. Rows are grouped by the account's own type, so a ledger account may give
    two. Balances missing for a whole group are NULL, missing turnover is zero.

    ``balances`` needs only the day before each month and the last day of it; of a
    mart partitioned by day nothing else is read when the period is one month.
    Facts are summed per account and month, in each task first, before they meet the
    accounts; of tables in buckets of the account nothing moves until then.
    """
    month = F.trunc("on_date", "MM")
    zero = F.lit(0).cast(MONEY)
    balance = F.col("balance_out_rub").cast(MONEY)

    # A month's last day closes that month and opens the next.
    sides = F.inline(
        F.array(
            F.struct(
                month.alias("from_date"), zero.alias("balance_in"), balance.alias("balance_out")
            ),
            F.struct(
                F.add_months(month, 1).alias("from_date"),
                balance.alias("balance_in"),
                zero.alias("balance_out"),
            ),
        )
    )
    edges = (
        balances.where(F.col("on_date").isin(period.day_before, *period.month_ends()))
        .select("account_rk", sides)
        .where(period.contains("from_date"))
        .groupBy("account_rk", "from_date")
        .agg(F.sum("balance_in").alias("balance_in"), F.sum("balance_out").alias("balance_out"))
    )
    moved = (
        turnover.where(period.contains("on_date"))
        .groupBy("account_rk", month.alias("from_date"))
        .agg(
            F.sum(F.col("debet_amount_rub").cast(MONEY)).alias("turn_deb"),
            F.sum(F.col("credit_amount_rub").cast(MONEY)).alias("turn_cre"),
        )
    )

    plan = ledger.select(
        "chapter",
        "ledger_account",
        F.col("start_date").alias("plan_from"),
        F.col("end_date").alias("plan_to"),
    )
    active = clip_to_period(
        accounts, period, "data_actual_date", "data_actual_end_date"
    ).select(
        "account_rk",
        F.substring("account_number", 1, 5).cast("int").alias("ledger_account"),
        F.col("char_type").alias("characteristic"),
        F.col("currency_code").isin(*RUBLE_CODES).alias("in_rubles"),
        "valid_from",
        "valid_to",
    )
    planned = active.join(plan, "ledger_account")
    covered = whole_months_of(
        F.greatest("valid_from", "plan_from"), F.least("valid_to", "plan_to")
    )
    dated = F.col("plan_from").isNotNull() & F.col("plan_to").isNotNull()
    reported = planned.where(dated).select(
        "account_rk",
        F.explode(covered).alias("from_date"),
        "chapter",
        "ledger_account",
        "characteristic",
        "in_rubles",
    )
    key = ["account_rk", "from_date"]
    joined = reported.join(edges, key, "left").join(moved, key, "left")

    # First by currency kind with one sum per amount, then spread over the columns:
    # the wide sums see a handful of rows per ledger account, not the accounts.
    groups = ["from_date", "chapter", "ledger_account", "characteristic"]
    summed = joined.groupBy(*groups, "in_rubles").agg(
        F.sum("balance_in").alias("balance_in"),
        F.sum(F.coalesce("turn_deb", F.lit(0))).alias("turn_deb"),
        F.sum(F.coalesce("turn_cre", F.lit(0))).alias("turn_cre"),
        F.sum("balance_out").alias("balance_out"),
    )
    in_rubles = F.col("in_rubles")

    def split(name: str) -> list[Column]:
        return [
            money(F.sum(F.when(in_rubles, F.col(name)).otherwise(0))).alias(f"{name}_rub"),
            money(F.sum(F.when(~in_rubles, F.col(name)).otherwise(0))).alias(f"{name}_val"),
            money(F.sum(name)).alias(f"{name}_total"),
        ]

    return (
        summed.groupBy(*groups)
        .agg(
            *split("balance_in"),
            *split("turn_deb"),
            *split("turn_cre"),
            *split("balance_out"),
        )
        .withColumn("to_date", F.last_day("from_date"))
        .withColumn("ledger_account", F.col("ledger_account").cast("string"))
        .select(*_HEAD, *FORM101_MEASURES)
    )


def form101_table(report: DataFrame) -> DataFrame:
    """The report in the shape of its stored table, with the empty ``r_`` columns."""
    return report.select(
        *[
            F.col(field.name)
            if field.name in report.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in DM_FORM101.schema
        ]
    )


def form101_text(table: DataFrame) -> DataFrame:
    """The stored table with its measures as eight-decimal text, ready for export;
    otherwise a zero would be written in exponent form."""
    return table.select(
        *[
            fixed_scale_text(name).alias(name) if name in FORM101_MEASURES else F.col(name)
            for name in table.columns
        ]
    )
