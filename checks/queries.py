"""One query per operator, over the whole of the tables it is given."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import tables as t
from daybook import operators as op
from daybook import plans, sources
from daybook.functions import Period, moscow_time, parse_date, parse_integer, parse_key, parse_number
from daybook.functions import to_code_page_bytes
from daybook.schemas import (
    DEAL,
    DM_BALANCE,
    FT_BALANCE,
    FT_POSTING,
    LEDGER_LOADED,
    MD_ACCOUNT,
    MD_LEDGER_ACCOUNT,
    MONEY,
    Table,
)
from daybook.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


# Marts


def turnover_daily(spark: SparkSession, sf: str) -> DataFrame:
    return op.turnover(
        t.postings(spark, sf), t.accounts(spark, sf), t.rates(spark, sf), t.HISTORY
    )


def turnover_dropped_legs(spark: SparkSession, sf: str) -> DataFrame:
    return op.dropped_legs(t.postings(spark, sf), t.accounts(spark, sf), t.HISTORY)


def rate_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Every order's amount with the rate that is valid for its customer's currency on its
    day; currencies without one, orders before a currency's first rate, have none."""
    orders = t.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").cast("date").alias("on_date"),
        F.round("o_totalprice", 2).cast(MONEY).alias("amount"),
    )
    customers = t.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("long").alias("currency_rk")
    )
    # Rates that end each spring and begin again in autumn.
    rates = t.rates(spark, sf).select(
        "currency_rk",
        F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"),
        "reduced_cource",
        "data_actual_date",
    )
    first = F.col("data_actual_date") < date(1998, 1, 1)
    seasons = rates.where(first).select(
        "currency_rk",
        F.make_date("year", F.lit(9), F.lit(1)).alias("start"),
        F.make_date(F.col("year") + 1, F.lit(4), F.lit(30)).alias("end"),
        (F.col("reduced_cource") + F.col("year")).cast("decimal(14,8)").alias("rate"),
    )
    joined = orders.join(customers, "c_custkey")
    return op.asof_join(joined, seasons, ["currency_rk"], "on_date", ("start", "end"), ["rate"], least=100)


def opening_balance(spark: SparkSession, sf: str) -> DataFrame:
    return op.opening_balances(
        t.snapshot(spark, sf), t.accounts(spark, sf), t.rates(spark, sf), t.HISTORY
    )


def _balances(spark: SparkSession, sf: str, days: str) -> DataFrame:
    return op.balances(
        t.accounts(spark, sf),
        turnover_daily(spark, sf),
        opening_balance(spark, sf),
        t.HISTORY,
        days=days,
    )


def balance_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Every account's balances on every day, by account and month: days, sums, range."""
    return (
        _balances(spark, sf, "all")
        .groupBy("account_rk", F.trunc("on_date", "MM").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("balance_out").cast(MONEY).alias("balance_out"),
            F.sum("balance_out_rub").cast(MONEY).alias("balance_out_rub"),
            F.min("balance_out").alias("least"),
            F.max("balance_out").alias("most"),
        )
    )


def balance_month_end(spark: SparkSession, sf: str) -> DataFrame:
    """Every account's balance at the end of each month."""
    return _balances(spark, sf, "month_ends")


def form101(spark: SparkSession, sf: str) -> DataFrame:
    """The report for every month of the history."""
    opening = opening_balance(spark, sf)
    moves = turnover_daily(spark, sf)
    accounts = op.in_parts(t.accounts(spark, sf), "account_rk")
    closing = op.balances(accounts, moves, opening, t.HISTORY, days="month_ends")
    return op.form101(
        accounts,
        t.ledger(spark, sf),
        moves,
        op.in_parts(closing.unionByName(opening), "account_rk"),
        t.HISTORY,
    )


def f101_export(spark: SparkSession, sf: str) -> DataFrame:
    return op.form101_text(op.form101_table(form101(spark, sf)))


def f101_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "form101-csv")
    sources.write_delimited(f101_export(spark, sf), path)
    return sources.read_form101_csv(spark, path)


#: Periods closed one after another: months with all their days, in some of which accounts are
#: opened, or end and begin again, and a longer one between them, of which month ends are kept.
CLOSED_FIRST = [Period(date(1995, m, 1), date(1995, m, n)) for m, n in ((1, 31), (2, 28), (3, 31))]
CLOSED_BETWEEN = Period(date(1995, 4, 1), date(1996, 1, 31))
CLOSED_LAST = [Period(date(1996, m, 1), date(1996, m, n)) for m, n in ((2, 29), (3, 31), (4, 30))]
CLOSED = Period(CLOSED_FIRST[0].start, CLOSED_LAST[-1].end)
#: A month whose close is logged.
LOGGED_MONTH = Period(date(1996, 2, 1), date(1996, 2, 29))


def month_close_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Balances from marts stored by day: periods closed one after another, each carrying
    on from the one before."""
    turnover_path = scratch_path(spark, "turnover")
    balance_path = scratch_path(spark, "balance")
    for period in (*CLOSED_FIRST, CLOSED_BETWEEN, *CLOSED_LAST):
        plans.publish_month(
            t.postings(spark, sf),
            t.accounts(spark, sf),
            t.rates(spark, sf),
            t.snapshot(spark, sf),
            period,
            turnover_path,
            balance_path,
            "snapshot" if period == CLOSED_FIRST[0] else "previous_close",
            days="month_ends" if period == CLOSED_BETWEEN else "all",
        )
    stored = sources.read_table(spark, balance_path, schema=DM_BALANCE.schema)
    return stored.where(CLOSED.contains("on_date")).select(DM_BALANCE.columns)


def close_log(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per day of a month's marts, as counted by the tasks that write them."""
    month = LOGGED_MONTH
    close = plans.publish_month(
        t.postings(spark, sf),
        t.accounts(spark, sf),
        t.rates(spark, sf),
        t.snapshot(spark, sf).withColumn("on_date", F.lit(month.day_before)),
        month,
        scratch_path(spark, "turnover"),
        scratch_path(spark, "balance"),
        counted=True,
    )
    counts = (("turnover", close.turnover_rows), ("balances", close.balance_rows))
    rows = [(step, d, n) for step, days in counts for d, n in days.items() if n]
    return spark.createDataFrame(rows, "step string, on_date date, row_count long")


def _late(postings: DataFrame) -> Column:
    """Postings that arrive after the close: small amounts, about a third."""
    return F.col("credit_amount") % 1 < 0.33


def late_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Month ends closed without late postings, then corrected by them."""
    accounts, rates, postings = t.accounts(spark, sf), t.rates(spark, sf), t.postings(spark, sf)
    late = _late(postings)
    moves = op.turnover(postings.where(~late), accounts, rates, t.HISTORY)
    closed = op.balances(accounts, moves, opening_balance(spark, sf), t.HISTORY, "month_ends")
    changed = op.late_turnover(postings.where(late), moves, accounts, rates, t.HISTORY)
    corrected = op.late_balances(changed, closed, t.HISTORY)
    key = ["on_date", "account_rk"]
    return op.upsert(closed, op.in_parts(corrected, *key), key)


def late_turnover(spark: SparkSession, sf: str) -> DataFrame:
    """Turnover closed without late postings, then corrected by them."""
    accounts, rates, postings = t.accounts(spark, sf), t.rates(spark, sf), t.postings(spark, sf)
    late = _late(postings)
    moves = op.turnover(postings.where(~late), accounts, rates, t.HISTORY)
    changed = op.late_turnover(postings.where(late), moves, accounts, rates, t.HISTORY)
    return op.upsert(moves, changed.select(moves.columns), ["on_date", "account_rk"])


def form101_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The report of every month from accounts and marts stored in buckets of the account."""
    accounts, opening = t.accounts(spark, sf), opening_balance(spark, sf)

    def bucketed(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "bucketed")
        return sources.write_bucketed(df, "b" + path.rpartition("-")[2], path, op.part_count(df))

    stored, moves = bucketed(accounts), bucketed(turnover_daily(spark, sf))
    closing = op.balances(stored, moves, opening, t.HISTORY, days="month_ends")
    marts = bucketed(closing.unionByName(opening))
    return op.form101(stored, t.ledger(spark, sf), moves, marts, t.HISTORY)


# Loading


def _written(spark: SparkSession, df: DataFrame, name: str, **options: str) -> str:
    path = scratch_path(spark, name)
    sources.write_delimited(df, path, **options)
    return path


def _capitals(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def typed_load(spark: SparkSession, sf: str) -> DataFrame:
    """Postings written as delimited text, read without copies and typed."""
    postings = t.postings(spark, sf)
    raw = postings.withColumn("oper_date", F.date_format("oper_date", "dd-MM-yyyy"))
    path = _written(spark, _capitals(raw), "postings-csv")
    return plans.typed_postings(sources.read_delimited(spark, path, dedupe=True))


def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Postings as text some lines of which are broken: good rows and rejected lines by
    what they break, with the amounts and the letters that they hold."""
    orders = t.table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    amount = F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    fields = [
        F.date_format(day, "yyyy/MM/dd"),
        F.col("o_custkey").cast("string"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise((F.col("o_custkey") + 1).cast("string")),
        F.when(F.col("o_totalprice") > 300_000, F.concat(amount, F.lit("x"))).otherwise(amount),
        amount,
    ]
    fields[0] = F.when(F.col("o_totalprice") < 2000, fields[0]).otherwise(F.date_format(day, "dd-MM-yyyy"))
    line = F.concat_ws(";", *fields[:4], F.when(~urgent, fields[4]))
    path = scratch_path(spark, "postings-csv")
    lines = orders.select(line.alias("value"))
    header = spark.createDataFrame([(";".join(FT_POSTING.columns).upper(),)], "value string")
    header.unionByName(lines).write.text(path)
    loaded = sources.read_checked(
        spark, path, FT_POSTING, patterns={"oper_date": "dd-MM-yyyy"}
    )
    good = loaded.rows.groupBy("oper_date").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("debet_amount").cast(MONEY).alias("amount")
    )
    rejected = loaded.rejects.groupBy(F.array_join("rules", "; ").alias("rules")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.length("line")).cast(MONEY).alias("amount")
    )
    return good.select(
        F.concat(F.lit("good "), F.col("oper_date").cast("string")).alias("rules"), "line_count", "amount"
    ).unionByName(rejected)


def typed_load_accounts(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, _capitals(t.accounts(spark, sf)), "accounts-csv")
    return plans.typed_accounts(sources.read_delimited(spark, path, dedupe=True))


def typed_load_rates(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, _capitals(t.rates(spark, sf)), "rates-csv")
    return plans.typed_rates(sources.read_delimited(spark, path, dedupe=True))


def typed_load_balances(spark: SparkSession, sf: str) -> DataFrame:
    raw = t.snapshot(spark, sf).withColumn("on_date", F.date_format("on_date", "dd.MM.yyyy"))
    path = _written(spark, _capitals(raw), "balances-csv")
    return plans.typed_balances(sources.read_delimited(spark, path, dedupe=True))


def typed_load_code_page(spark: SparkSession, sf: str) -> DataFrame:
    """Deals with Cyrillic text, written and read in a Windows code page."""
    encoding = "windows-1251"
    raw = t.deals(spark, sf)
    encoded = raw.select(
        [
            to_code_page_bytes(f.name, encoding).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in raw.schema
        ]
    )
    path = _written(spark, encoded, "deals-csv", sep=",", encoding="iso-8859-1")
    return sources.read_delimited(spark, path, sep=",", schema=DEAL.schema, encoding=encoding)


def _currencies(spark: SparkSession, sf: str) -> DataFrame:
    """The rates' currencies as the currency file has them."""
    return t.rates(spark, sf).select(
        "currency_rk",
        "data_actual_date",
        "data_actual_end_date",
        F.col("code_iso_num").alias("currency_code"),
        F.lit(None).cast("string").alias("code_iso_char"),
    )


def _ledger_file(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger plan with the columns of its file, those it lacks empty."""
    ledger = t.ledger(spark, sf)
    return ledger.select(
        [
            F.col(c) if c in ledger.columns else F.lit(None).cast(MD_LEDGER_ACCOUNT.schema[c].dataType).alias(c)
            for c in LEDGER_LOADED
        ]
    )


def typed_load_currencies(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, _capitals(_currencies(spark, sf)), "currencies-csv")
    return plans.typed_currencies(sources.read_delimited(spark, path, dedupe=True))


def typed_load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, _capitals(_ledger_file(spark, sf)), "ledger-csv")
    return plans.typed_ledger(sources.read_delimited(spark, path, dedupe=True))


def detail_load(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the six tables loaded over older contents."""
    accounts, rates = t.accounts(spark, sf), t.rates(spark, sf)
    snapshot, ledger = t.snapshot(spark, sf), t.ledger(spark, sf)
    currencies, plan = _currencies(spark, sf), _ledger_file(spark, sf)
    text = {
        "md_account_d": accounts,
        "md_currency_d": currencies,
        "md_exchange_rate_d": rates,
        "md_ledger_account_s": plan,
        "ft_balance_f": snapshot.withColumn("on_date", F.date_format("on_date", "dd.MM.yyyy")),
        "ft_posting_f": t.postings(spark, sf).withColumn(
            "oper_date", F.date_format("oper_date", "dd-MM-yyyy")
        ),
    }
    raw = {
        name: sources.read_delimited(
            spark, _written(spark, _capitals(df), f"{name}-csv"), dedupe=True
        )
        for name, df in text.items()
    }
    # Older contents: every version under an older end, and ledger rows with a
    # column the load does not supply.
    current = {
        "md_account_d": accounts.withColumn("char_type", F.lit("?")),
        "md_currency_d": currencies.withColumn("code_iso_char", F.lit("OLD")),
        "md_exchange_rate_d": rates.withColumn("reduced_cource", F.lit(0).cast("decimal(14,8)")),
        "md_ledger_account_s": ledger.where(F.col("chapter") == "А").select(
            [
                F.lit(7).alias(c)
                if c == "is_loan"
                else F.col(c)
                if c in ledger.columns
                else F.lit(None).cast(MD_LEDGER_ACCOUNT.schema[c].dataType).alias(c)
                for c in MD_LEDGER_ACCOUNT.columns
            ]
        ),
        "ft_balance_f": snapshot.withColumn("on_date", F.date_sub("on_date", 31)),
    }
    loaded = plans.load_detail(raw, current)
    # Every row of every table, in columns that all tables have.
    shapes = {
        "md_account_d": ("data_actual_date", "data_actual_end_date", "account_rk", ["account_number", "char_type", "currency_rk", "currency_code"], None),
        "md_currency_d": ("data_actual_date", "data_actual_end_date", "currency_rk", ["currency_code", "code_iso_char"], None),
        "md_exchange_rate_d": ("data_actual_date", "data_actual_end_date", "currency_rk", ["code_iso_num"], "reduced_cource"),
        "md_ledger_account_s": ("start_date", "end_date", "ledger_account", ["chapter", "chapter_name", "characteristic"], "is_loan"),
        "ft_balance_f": ("on_date", None, "account_rk", ["currency_rk"], "balance_out"),
        "ft_posting_f": ("oper_date", None, "credit_account_rk", ["debet_account_rk"], "debet_amount"),
    }

    def rows(name: str) -> DataFrame:
        start, end, key, texts, amount = shapes[name]
        return loaded[name].select(
            F.lit(name).alias("table_name"),
            F.col(start).alias("from_date"),
            (F.col(end) if end else F.lit(None).cast("date")).alias("to_date"),
            F.col(key).cast("long").alias("key"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in texts]).alias("texts"),
            (F.col(amount) if amount else F.lit(None)).cast(MONEY).alias("amount"),
        )

    return reduce(DataFrame.unionByName, map(rows, shapes))


def detail_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Opening balances and turnover from fact tables stored by day, after a first load and
    a delivery that names one more day and some keys anew."""
    folder = scratch_path(spark, "facts")
    snapshot, postings = t.snapshot(spark, sf), t.postings(spark, sf)

    def raw(df: DataFrame, name: str, day: str, pattern: str) -> DataFrame:
        text = _capitals(df.withColumn(day, F.date_format(day, pattern)))
        return sources.read_delimited(spark, _written(spark, text, f"{name}-csv"))

    older = snapshot.withColumn("balance_out", F.col("balance_out") + 1)
    older = older.unionByName(older.withColumn("on_date", F.date_sub("on_date", 1)))
    plans.load_facts(
        {
            FT_BALANCE.name: raw(older, FT_BALANCE.name, "on_date", "dd.MM.yyyy"),
            FT_POSTING.name: raw(postings, FT_POSTING.name, "oper_date", "dd-MM-yyyy"),
        },
        folder,
    )
    # Accounts that are not overdrawn are delivered again.
    delivered = raw(snapshot.where("balance_out >= 0"), FT_BALANCE.name, "on_date", "dd.MM.yyyy")
    plans.load_facts({FT_BALANCE.name: delivered}, folder)
    stored = sources.read_table(spark, f"{folder}/{FT_BALANCE.name}", schema=FT_BALANCE.schema)
    held = sources.read_table(spark, f"{folder}/{FT_POSTING.name}", schema=FT_POSTING.schema)
    balances = stored.select("on_date", "account_rk", "balance_out", F.lit("balance").alias("kind"))
    moves = op.posting_legs(held, t.HISTORY).select(
        "on_date", "account_rk", F.col("credit_amount").alias("balance_out"), F.lit("credit").alias("kind")
    )
    return balances.unionByName(moves)


# Table maintenance


def _new_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals by customer as balances, keyed by the customer or, shifted, new."""
    per_customer = (
        t.table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.sum(F.round("o_totalprice", 2).cast("decimal(18,2)")).cast(MONEY).alias("balance_out"))
    )
    return per_customer.select(
        F.lit(t.HISTORY.day_before).alias("on_date"),
        (F.col("o_custkey") + 20).alias("account_rk"),
        F.lit(None).cast("long").alias("currency_rk"),
        "balance_out",
    )


def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return op.upsert(t.snapshot(spark, sf), _new_snapshot(spark, sf), FT_BALANCE.key)


def keyed_upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    """Part names and prices replaced from order lines; brand and size are kept."""
    parts = t.table(spark, sf, "part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        "p_size",
        F.round("p_retailprice", 2).cast(MONEY).alias("price"),
    )
    delivered = (
        t.table(spark, sf, "lineitem")
        .groupBy((F.col("l_partkey") + 50).alias("p_partkey"))
        .agg(
            F.max(F.round("l_extendedprice", 2).cast("decimal(18,2)")).cast(MONEY).alias("price"),
        )
        .withColumn("p_name", F.concat(F.lit("part "), F.col("p_partkey").cast("string")))
    )
    return op.upsert(parts, delivered, ["p_partkey"], ["p_partkey", "p_name", "price"])


def replace_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of 1996 replaced by the lines shipped then; undated orders stay."""
    day = F.col("o_orderdate").cast("date")
    stored = t.table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", day).alias("on_date"),
        F.col("o_orderkey").alias("number"),
        F.round("o_totalprice", 2).cast(MONEY).alias("amount"),
    )
    year = Period(date(1996, 1, 1), date(1996, 12, 31))
    shipped = (
        t.table(spark, sf, "lineitem")
        .select(
            F.col("l_shipdate").cast("date").alias("on_date"),
            F.col("l_orderkey").alias("number"),
            F.round("l_extendedprice", 2).cast(MONEY).alias("amount"),
        )
        .where(year.contains("on_date"))
    )
    return op.replace_slice(stored, year.contains("on_date"), shipped)


def append_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Client versions of the older orders, extended by a delivery of all."""
    old = t.clients(spark, sf).where(F.col("effective_from_date") < date(1998, 1, 1))
    return op.append_new(old, t.clients(spark, sf))


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "products")
    sources.overwrite_table(t.products(spark, sf).limit(7), path)
    sources.overwrite_table(op.dedupe(t.products(spark, sf)), path)
    return sources.read_table(spark, path)


def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    return op.dedupe(t.clients(spark, sf))


# Quality


LINE = Table(
    "lineitem",
    T.StructType(),
    key=("l_orderkey", "l_linenumber"),
    required=("l_orderkey", "l_linenumber", "l_shipdate"),
    max_length={"l_returnflag": 1, "l_linestatus": 1},
)
ORDER_VERSION = Table(
    "order_versions",
    T.StructType(),
    key=("account_rk", "data_actual_date"),
    required=("account_rk", "status"),
    interval=("data_actual_date", "data_actual_end_date"),
    max_length={"priority": 5},
)


def contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    versions = t.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("account_rk"),
        day.alias("data_actual_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(day, 100)).alias(
            "data_actual_end_date"
        ),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    return reduce(
        DataFrame.unionByName,
        [
            op.violations(t.accounts(spark, sf), MD_ACCOUNT),
            op.violations(t.postings(spark, sf), FT_POSTING),
            op.violations(t.table(spark, sf, "lineitem"), LINE),
            op.violations(versions, ORDER_VERSION),
        ],
    )


def duplicate_profile(spark: SparkSession, sf: str) -> DataFrame:
    return op.duplicate_profile(t.clients(spark, sf))


def duplicate_key_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.table(spark, sf, "lineitem")
    lines = lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return op.duplicate_key_rows(lines, ["l_orderkey", "l_linenumber"])


def nonnull_profile(spark: SparkSession, sf: str) -> DataFrame:
    return op.nonnull_profile(
        loan_holiday_mart(spark, sf), ["effective_from_date", "effective_to_date"]
    )


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            op.step_audit(
                "turnover", turnover_daily(spark, sf), amount="credit_amount_rub"
            ),
            op.step_audit(
                "dropped legs", turnover_dropped_legs(spark, sf), amount="debet_amount"
            ),
            op.step_audit("opening", opening_balance(spark, sf), amount="balance_out_rub"),
            op.step_audit(
                "month ends", balance_month_end(spark, sf), amount="balance_out_rub"
            ),
        ],
    )


def step_audit(spark: SparkSession, sf: str) -> DataFrame:
    return _audit(spark, sf)


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    return op.run_log(_audit(spark, sf)).select("log_type", "log_message")


# Loans and continuity


def loan_holiday_mart(spark: SparkSession, sf: str) -> DataFrame:
    return op.loan_holiday_mart(
        t.deals(spark, sf), t.holidays(spark, sf), t.products(spark, sf)
    )


def balance_repair_in(spark: SparkSession, sf: str) -> DataFrame:
    return op.repair_in_sums(t.account_balance(spark, sf))


def balance_corrections_in(spark: SparkSession, sf: str) -> DataFrame:
    return op.in_sum_corrections(t.account_balance(spark, sf))


def balance_repair_out(spark: SparkSession, sf: str) -> DataFrame:
    return op.out_sum_corrections(t.account_balance(spark, sf))


def balance_repair_preview(spark: SparkSession, sf: str) -> DataFrame:
    corrected = op.in_sum_corrections(t.account_balance(spark, sf))
    return op.preview(corrected, ["account_rk", "effective_date"])


def account_balance_turnover(spark: SparkSession, sf: str) -> DataFrame:
    _, mart = plans.repair_and_publish(
        t.bank_accounts(spark, sf), t.account_balance(spark, sf), t.currency_names(spark, sf)
    )
    return mart.orderBy("account_rk", "effective_date")


# Scalar functions


def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Dates, numbers and fixed-scale text of every order, through text and back."""
    day = F.col("o_orderdate").cast("date")
    text = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.substring("o_orderpriority", 1, 1).alias("digit_text"),
        F.date_format(day, "yyyy-MM-dd").alias("iso_text"),
        F.date_format(day, "dd.MM.yyyy").alias("dotted_text"),
        F.date_format(day, "dd-MM-yyyy").alias("dashed_text"),
        F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string").alias("amount_text"),
    )
    amount = parse_number("amount_text")
    return text.select(
        parse_key("key_text").alias("order_rk"),
        parse_integer("digit_text", 3).alias("priority"),
        parse_date("iso_text").alias("iso_day"),
        F.add_months(parse_date("dotted_text", "dd.MM.yyyy"), -1).alias("month_before"),
        F.date_sub(parse_date("dashed_text", "dd-MM-yyyy"), 1).alias("day_before"),
        amount.alias("amount"),
        F.regexp_replace(F.format_number(-amount, 8), ",", "").alias("amount_text"),
    )


def moscow_times(spark: SparkSession, sf: str) -> DataFrame:
    """Every event's time as a clock in Moscow shows it."""
    return t.table(spark, sf, "events").select(
        "event_id", F.date_format(moscow_time("ts"), "yyyy-MM-dd HH:mm:ss").alias("moscow")
    )


def _by_itself(query: Query) -> Query:
    """The query with plans of its own: what it costs does not hang on what ran before."""

    @wraps(query)
    def alone(spark: SparkSession, sf: str) -> DataFrame:
        t.forget_plans()
        return query(spark, sf)

    return alone


QUERIES: dict[str, Query] = {
    f.__name__: _by_itself(f)
    for f in (
        turnover_daily,
        turnover_dropped_legs,
        rate_asof,
        opening_balance,
        balance_daily,
        balance_month_end,
        form101,
        f101_export,
        f101_csv_roundtrip,
        month_close_stored,
        close_log,
        late_postings,
        late_turnover,
        form101_bucketed,
        detail_by_day,
        typed_load,
        load_rejects,
        typed_load_accounts,
        typed_load_rates,
        typed_load_balances,
        typed_load_code_page,
        typed_load_currencies,
        typed_load_ledger,
        detail_load,
        keyed_upsert,
        keyed_upsert_partial,
        replace_slice,
        append_new_rows,
        full_refresh,
        dedupe_rows,
        contract_violations,
        duplicate_profile,
        duplicate_key_rows,
        nonnull_profile,
        step_audit,
        run_log,
        loan_holiday_mart,
        balance_repair_in,
        balance_corrections_in,
        balance_repair_out,
        balance_repair_preview,
        account_balance_turnover,
        scalar_functions,
        moscow_times,
    )
}
