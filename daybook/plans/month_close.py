"""Month close: daily marts, then form 101 and its export."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import Period
from daybook.operators.balances import balances, opening_balances
from daybook.operators.form101 import form101, form101_table, form101_text
from daybook.operators.late import late_balances, late_turnover
from daybook.operators.maintain import replace_slice
from daybook.operators.turnover import turnover
from daybook.schemas import DM_BALANCE, DM_TURNOVER
from daybook.session import scratch_path
from daybook.sources.readers import read_table
from daybook.sources.writers import merge_days, replace_days, write_delimited


@dataclass(frozen=True)
class MonthClose:
    """The marts' rows for a period. ``balances`` begins with the day before it
    when the opening balances were taken from the snapshot."""

    period: Period
    turnover: DataFrame
    balances: DataFrame
    balances_from: Period
    #: Rows written per day, where they were counted.
    turnover_rows: dict[date, int] | None = None
    balance_rows: dict[date, int] | None = None

    def into(
        self, turnover_mart: DataFrame, balance_mart: DataFrame
    ) -> tuple[DataFrame, DataFrame]:
        """The whole marts with this period's rows replaced."""
        return (
            replace_slice(turnover_mart, self.period.contains("on_date"), self.turnover),
            replace_slice(balance_mart, self.balances_from.contains("on_date"), self.balances),
        )


def close_month(
    postings: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    snapshot: DataFrame,
    period: Period,
    opening: Literal["snapshot", "previous_close"] = "snapshot",
    balance_mart: DataFrame | None = None,
) -> MonthClose:
    """Turnover and balances of a period, usually one month.

    Every day of the period is replaced, also days that lost all their postings.

    ``opening="snapshot"`` takes the opening balances from the balance snapshot of
    the day before, and replaces that day in the mart as well.
    ``opening="previous_close"`` carries on from the mart's own rows of that day.
    """
    moves = turnover(postings, accounts, rates, period)
    if opening == "snapshot":
        seeds = opening_balances(snapshot, accounts, rates, period)
        carried = balances(accounts, moves, seeds, period).unionByName(seeds)
        return MonthClose(period, moves, carried, Period(period.day_before, period.end))
    if balance_mart is None:
        raise ValueError("previous_close needs the balance mart")
    seeds = balance_mart.where(F.col("on_date") == F.lit(period.day_before))
    return MonthClose(period, moves, balances(accounts, moves, seeds, period), period)


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_month(
    postings: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    snapshot: DataFrame,
    period: Period,
    turnover_path: str,
    balance_path: str,
    opening: Literal["snapshot", "previous_close"] = "snapshot",
    days: Literal["all", "month_ends"] = "all",
    counted: bool = False,
) -> MonthClose:
    """Close a period into marts stored by day, and return its stored rows.
    ``days="month_ends"`` stores only the balances form 101 needs. Each day's rows are
    brought together once before they are written, so that files are few and large.
    ``counted`` counts each day's rows while they are written (see ``replace_days``).

    Turnover and balances are both computed into a scratch folder before either mart
    is touched: a close that fails leaves the stored month as it was. Each step starts
    from files, so a lost executor costs a retried task and a failed job can be run
    again from the beginning.
    """
    spark = postings.sparkSession
    moves = _staged(turnover(postings, accounts, rates, period), "turnover")
    if opening == "snapshot":
        seeds = opening_balances(snapshot, accounts, rates, period)
        replaced = Period(period.day_before, period.end)
        rows = balances(accounts, moves, seeds, period, days).unionByName(seeds)
    else:
        stored = read_table(spark, balance_path, schema=DM_BALANCE.schema)
        seeds = stored.where(F.col("on_date") == F.lit(period.day_before))
        replaced = period
        rows = balances(accounts, moves, seeds, period, days)
    rows = _staged(rows, "balances")
    turnover_rows = replace_days(moves, turnover_path, period, counted=counted)
    balance_rows = replace_days(rows, balance_path, replaced, counted=counted)
    moves = read_table(spark, turnover_path, schema=DM_TURNOVER.schema).where(
        period.contains("on_date")
    )
    carried = read_table(spark, balance_path, schema=DM_BALANCE.schema).where(
        replaced.contains("on_date")
    )
    return MonthClose(
        period,
        moves.select(DM_TURNOVER.columns),
        carried.select(DM_BALANCE.columns),
        replaced,
        turnover_rows,
        balance_rows,
    )


def apply_late(
    late: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    turnover_path: str,
    balance_path: str,
    closed: Period,
) -> None:
    """Bring postings that arrived after the close into marts closed over ``closed``.

    The marts become what a close with all postings gives, without closing again: the
    late postings' days of the turnover mart are merged, and of the balance mart the
    days from the first late one on, on which a touched account has a row. Both sets of
    rows are computed from the marts as they were, and written, before either mart is
    changed. Late postings carry no number of their own, so bringing the same
    ones in twice counts them twice: after a failure between the two marts, go on with
    the rows in the scratch folder or close the month again.
    """
    spark = late.sparkSession
    days = late.agg(F.min("oper_date"), F.max("oper_date")).first()
    if days[0] is None or days[0] > closed.end or days[1] < closed.start:
        return
    touched = Period(max(days[0], closed.start), closed.end)
    stored = read_table(spark, turnover_path, schema=DM_TURNOVER.schema)
    in_late_days = F.col("on_date") <= F.lit(days[1])
    changed = _staged(
        late_turnover(
            late, stored.where(touched.contains("on_date") & in_late_days), accounts, rates, closed
        ),
        "late-turnover",
    )
    carried = read_table(spark, balance_path, schema=DM_BALANCE.schema)
    moved = _staged(late_balances(changed, carried, touched), "late-balances")
    merge_days(
        changed.select(DM_TURNOVER.columns), turnover_path, DM_TURNOVER.key, schema=DM_TURNOVER.schema
    )
    merge_days(moved, balance_path, DM_BALANCE.key, schema=DM_BALANCE.schema)


def export_form101(
    accounts: DataFrame,
    ledger: DataFrame,
    close: MonthClose,
    path: str,
) -> None:
    """Compute form 101 of a closed period and write it as delimited text."""
    report = form101(accounts, ledger, close.turnover, close.balances, close.period)
    write_delimited(form101_text(form101_table(report)), path)
