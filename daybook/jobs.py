"""The bank's regular jobs, for ``spark-submit``.

Tables are parquet folders named after the table, inside the folders given as
arguments. A job that changes a table writes the new contents to another folder
than the one it reads; only the marts, stored by day, are changed in place.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook import operators as op
from daybook import plans, sources
from daybook.functions import Period, month_of_report, moscow_now
from daybook.schemas import (
    ACCOUNT_BALANCE,
    DEAL,
    DM_BALANCE,
    DM_FORM101,
    DM_TURNOVER,
    FT_BALANCE,
    FT_POSTING,
    LOAN_HOLIDAY,
    MD_ACCOUNT,
    MD_CURRENCY,
    MD_EXCHANGE_RATE,
    MD_LEDGER_ACCOUNT,
    PRODUCT,
    Table,
)
from daybook.session import configure

# Written only by these jobs, so their columns are known; they may still be empty.
MARTS = (DM_TURNOVER, DM_BALANCE, DM_FORM101)
# Stored by day and changed in place.
FACTS = (FT_BALANCE, FT_POSTING)
DETAIL = (MD_ACCOUNT, MD_CURRENCY, MD_EXCHANGE_RATE, MD_LEDGER_ACCOUNT, FT_BALANCE, FT_POSTING)


def _table(spark: SparkSession, folder: str | None, table: Table) -> DataFrame:
    if folder is None:
        return spark.createDataFrame([], table.schema)
    schema = table.schema if table in MARTS + FACTS else None
    df = sources.read_table(spark, f"{folder}/{table.name}", schema=schema)
    return df.select(table.columns) if table in FACTS else df


def _log_days(spark: SparkSession, step: str, counts: dict[date, int] | None, folder: str | None) -> None:
    """Log the rows of each day as they were counted while they were written."""
    written = [(step, day, n) for day, n in sorted((counts or {}).items()) if n]
    if folder and written:
        audit = spark.createDataFrame(written, "step string, on_date date, row_count long")
        op.run_log(audit).coalesce(1).write.mode("append").parquet(folder)


def _log_message(spark: SparkSession, log_type: str, text: str, folder: str | None) -> None:
    if folder:
        entry = spark.createDataFrame([(log_type, text)], "log_type string, log_message string")
        entry.select(moscow_now().alias("date_time"), "log_type", "log_message").write.mode(
            "append"
        ).parquet(folder)


def logged(spark: SparkSession, a: argparse.Namespace) -> None:
    """Run a command between a start message and a message of its end or error. An
    error is logged with its first line and raised."""
    name, folder = a.run.__name__.replace("_", "-"), getattr(a, "log", None)
    _log_message(spark, "info", f"{name}: start", folder)
    try:
        a.run(spark, a)
    except Exception as error:
        _log_message(spark, "error", f"{name}: {type(error).__name__}: {str(error)[:500]}", folder)
        raise
    _log_message(spark, "info", f"{name}: end", folder)


def load_detail(spark: SparkSession, a: argparse.Namespace) -> None:
    """Merge the raw files into the detail tables: dimensions from --current to
    --output, balances and postings in place, by day, in --facts (by default --output)."""
    raw = {
        t.name: sources.read_delimited(spark, f"{a.raw}/{t.name}.csv", dedupe=True)
        for t in DETAIL
    }
    current = {t.name: _table(spark, a.current, t) for t in DETAIL if t not in FACTS}
    for name, df in plans.load_dimensions(raw, current).items():
        count = Observation()
        sources.overwrite_table(df.observe(count, F.count(F.lit(1)).alias("rows")), f"{a.output}/{name}")
        _log_message(spark, "info", f"{name}: {count.get['rows']} rows", a.log)
    plans.load_facts(raw, a.facts or a.output)


def check_detail(spark: SparkSession, a: argparse.Namespace) -> None:
    """Show every contract rule the detail tables break."""
    for table in DETAIL:
        found = op.violations(_table(spark, a.detail, table), table)
        found.where(F.col("violations") > 0).show(truncate=False)


def close_month(spark: SparkSession, a: argparse.Namespace) -> None:
    """Turnover and balances of the month before the report date."""
    period = month_of_report(a.report_date)
    accounts = _table(spark, a.detail, MD_ACCOUNT)
    facts = a.facts or a.detail
    postings = _table(spark, facts, FT_POSTING)
    close = plans.publish_month(
        postings,
        accounts,
        _table(spark, a.detail, MD_EXCHANGE_RATE),
        _table(spark, facts, FT_BALANCE),
        period,
        f"{a.marts}/{DM_TURNOVER.name}",
        f"{a.marts}/{DM_BALANCE.name}",
        a.opening,
        counted=bool(a.log),
    )
    _log_days(spark, "turnover", close.turnover_rows, a.log)
    _log_days(spark, "balances", close.balance_rows, a.log)
    if a.log:
        op.run_log(
            op.dropped_legs(postings, accounts, period).select(
                F.lit("legs of accounts not valid").alias("step"),
                "on_date",
                (F.col("credit_legs") + F.col("debet_legs")).alias("row_count"),
            ),
            "warning",
        ).write.mode("append").parquet(a.log)


def apply_late(spark: SparkSession, a: argparse.Namespace) -> None:
    """Bring postings delivered after the close into the marts of closed days."""
    late = sources.read_delimited(spark, a.postings)
    plans.apply_late(
        plans.typed_postings(late),
        _table(spark, a.detail, MD_ACCOUNT),
        _table(spark, a.detail, MD_EXCHANGE_RATE),
        f"{a.marts}/{DM_TURNOVER.name}",
        f"{a.marts}/{DM_BALANCE.name}",
        Period(a.first_day, a.last_day),
    )


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    """Form 101 from the stored marts: its table's month is replaced, and the whole
    table exported, or with --month-only the month."""
    period = month_of_report(a.report_date)
    first = Period(period.start, period.start)
    path = f"{a.marts}/{DM_FORM101.name}"
    form = op.form101(
        _table(spark, a.detail, MD_ACCOUNT),
        _table(spark, a.detail, MD_LEDGER_ACCOUNT),
        _table(spark, a.marts, DM_TURNOVER),
        _table(spark, a.marts, DM_BALANCE),
        period,
    )
    written = sources.replace_days(
        op.form101_table(form), path, first, day="from_date", counted=True
    )
    shown = _table(spark, a.marts, DM_FORM101)
    shown = shown.where(first.contains("from_date")) if a.month_only else shown
    text = op.form101_text(shown.select(DM_FORM101.columns))
    sources.write_delimited(text, a.csv)
    _log_days(spark, "form 101", written, a.log)


def import_report(spark: SparkSession, a: argparse.Namespace) -> None:
    """An exported form 101 back into a table."""
    sources.overwrite_table(sources.read_form101_csv(spark, a.csv), a.output)


def clean_clients(spark: SparkSession, a: argparse.Namespace) -> None:
    """Profile a client table, write it without copies, show keys still repeated."""
    clients = sources.read_table(spark, a.table)
    op.duplicate_profile(clients).show(truncate=False)
    sources.overwrite_table(op.dedupe(clients), a.output)
    cleaned = sources.read_table(spark, a.output)
    op.duplicate_key_rows(cleaned, ["client_rk", "effective_from_date"]).show(a.show)


def refresh_loans(spark: SparkSession, a: argparse.Namespace) -> None:
    """Products and deals from files, then the loan-holiday mart and its profile."""

    def delivered(path: str, table: Table) -> DataFrame:
        return sources.read_delimited(
            spark, path, sep=",", encoding="windows-1251", schema=table.schema
        )

    products, deals, _ = plans.refresh_loans(
        delivered(a.products, PRODUCT),
        delivered(a.deals, DEAL),
        _table(spark, a.current, DEAL),
        _table(spark, a.current, LOAN_HOLIDAY),
    )
    sources.overwrite_table(products, f"{a.output}/{PRODUCT.name}")
    sources.overwrite_table(deals, f"{a.output}/{DEAL.name}")
    mart = op.loan_holiday_mart(
        _table(spark, a.output, DEAL),
        _table(spark, a.current, LOAN_HOLIDAY),
        _table(spark, a.output, PRODUCT),
    )
    sources.overwrite_table(mart, f"{a.output}/loan_holiday_info")
    stored = sources.read_table(spark, f"{a.output}/loan_holiday_info")
    op.nonnull_profile(stored, ["effective_from_date", "effective_to_date"]).show(a.show)


def repair_balances(spark: SparkSession, a: argparse.Namespace) -> None:
    """Show corrections, write repaired balances and the mart built from them."""
    stored = _table(spark, a.tables, ACCOUNT_BALANCE)
    order = ["account_rk", "effective_date"]
    op.preview(op.in_sum_corrections(stored), order).show(40)
    op.preview(op.out_sum_corrections(stored), order).show(40)
    sources.overwrite_table(op.repair_in_sums(stored), f"{a.output}/{ACCOUNT_BALANCE.name}")
    mart = op.account_balance_turnover(
        sources.read_table(spark, f"{a.tables}/account"),
        _table(spark, a.output, ACCOUNT_BALANCE),
        sources.read_table(spark, f"{a.tables}/dict_currency"),
    )
    sources.overwrite_table(mart, f"{a.output}/account_balance_turnover")
    written = sources.read_table(spark, f"{a.output}/account_balance_turnover")
    op.preview(written, order, 30).show(30)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(run: Callable, **arguments: dict) -> None:
        sub = commands.add_parser(run.__name__.replace("_", "-"), help=run.__doc__)
        sub.set_defaults(run=run)
        for name, options in arguments.items():
            sub.add_argument("--" + name.replace("_", "-"), **options)

    needed = {"required": True}
    day = {"required": True, "type": date.fromisoformat}
    number = {"type": int, "default": 20}
    command(
        load_detail,
        raw=needed,
        output=needed,
        current={"help": "none for a first load"},
        facts={"help": "folder of the tables stored by day; as --output if not given"},
        log={},
    )
    command(
        apply_late, postings=needed, detail=needed, marts=needed, first_day=day, last_day=day, log={}
    )
    command(check_detail, detail=needed)
    command(
        close_month,
        report_date=day,
        detail=needed,
        marts=needed,
        facts={"help": "folder of the tables stored by day; as --detail if not given"},
        opening={"choices": ("snapshot", "previous_close"), "default": "snapshot"},
        log={},
    )
    command(
        report,
        report_date=day,
        detail=needed,
        marts=needed,
        csv=needed,
        month_only={"action": "store_true"},
        log={},
    )
    command(import_report, csv=needed, output=needed)
    command(clean_clients, table=needed, output=needed, show=number)
    command(
        refresh_loans,
        products=needed,
        deals=needed,
        current=needed,
        output=needed,
        show=number,
    )
    command(repair_balances, tables=needed, output=needed)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    logged(configure(SparkSession.builder.appName("daybook").getOrCreate()), args)


if __name__ == "__main__":
    main()
