"""Bank tables derived from the shared test tables, row for row.

``checks.oracle`` derives the same tables in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions import Period
from daybook.schemas import ACTIVE, MONEY, PASSIVE, RATE

# Every order lies in this period.
HISTORY = Period(date(1995, 1, 1), date(2001, 8, 31))
FAR_PAST, FAR_FUTURE = date(1990, 1, 1), date(2050, 12, 31)


# Building a table's plan takes far longer than looking it up, and a query names
# some tables several times. Only plans are kept, no data, and only for one query.
_plans: list[Callable] = []


def _planned_once(make: Callable) -> Callable:
    kept = lru_cache(maxsize=64)(make)
    _plans.append(kept)
    return kept


def forget_plans() -> None:
    """Let the next query list files and read schemas itself."""
    for kept in _plans:
        kept.cache_clear()


@_planned_once
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kopecks(column: str | Column) -> Column:
    return F.round(column, 2).cast("decimal(18,2)")


def _amount(column: str | Column) -> Column:
    return _kopecks(column).cast(MONEY)


@_planned_once
def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts: some with a gap between two versions, some opened in
    mid-month, some whose type changes between adjoining versions."""
    key = F.col("c_custkey")

    def version(start: date, end: date, shift: int) -> Column:
        return F.struct(
            F.lit(start).alias("data_actual_date"),
            F.lit(end).alias("data_actual_end_date"),
            F.lit(shift).alias("shift"),
        )

    versions = (
        F.when(
            key % 5 == 0,
            F.array(
                version(FAR_PAST, date(1996, 3, 10), 0), version(date(1996, 3, 21), FAR_FUTURE, 0)
            ),
        )
        .when(key % 7 == 1, F.array(version(date(1995, 1, 15), FAR_FUTURE, 0)))
        .when(
            key % 11 == 2,
            F.array(
                version(FAR_PAST, date(1997, 6, 14), 0), version(date(1997, 6, 15), FAR_FUTURE, 1)
            ),
        )
        .otherwise(F.array(version(FAR_PAST, FAR_FUTURE, 0)))
    )
    kind = (key + F.col("shift")) % 3
    nation = F.col("c_nationkey")
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey", F.inline(versions))
        .select(
            "data_actual_date",
            "data_actual_end_date",
            key.alias("account_rk"),
            F.concat(
                (30101 + key % 27).cast("string"), F.lpad(key.cast("string"), 15, "0")
            ).alias("account_number"),
            # The third type is a Latin letter.
            F.when(kind == 0, ACTIVE).when(kind == 1, PASSIVE).otherwise("A").alias("char_type"),
            nation.cast("long").alias("currency_rk"),
            F.when(nation == 0, "643")
            .when(nation == 1, "810")
            .otherwise((100 + nation).cast("string"))
            .alias("currency_code"),
        )
    )


@_planned_once
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rates per nation, one after the other. Currencies 0 to 2 have none."""
    nation = F.col("n_nationkey")

    def version(start: date, end: date, base: str, step: str) -> Column:
        return F.struct(
            F.lit(start).alias("data_actual_date"),
            F.lit(end).alias("data_actual_end_date"),
            (F.lit(Decimal(base)) + nation * F.lit(Decimal(step))).cast(RATE).alias(
                "reduced_cource"
            ),
        )

    return (
        table(spark, sf_dir, "nation")
        .select(
            "n_nationkey",
            F.inline(
                F.array(
                    version(FAR_PAST, date(1998, 2, 14), "1.5", "0.73125001"),
                    version(date(1998, 2, 15), FAR_FUTURE, "0.25", "1.00000003"),
                )
            ),
        )
        .select(
            "data_actual_date",
            "data_actual_end_date",
            (nation + 3).cast("long").alias("currency_rk"),
            "reduced_cource",
            (103 + nation).cast("string").alias("code_iso_num"),
        )
    )


@_planned_once
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger account per nation; one of them ends during the history."""
    nation = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.when(F.col("n_regionkey") < 3, "А").otherwise("Б").alias("chapter"),
        (30101 + nation).cast("int").alias("ledger_account"),
        F.lit(FAR_PAST).alias("start_date"),
        F.when(nation == 17, F.lit(date(1997, 9, 15)))
        .otherwise(F.lit(FAR_FUTURE))
        .alias("end_date"),
    )


@_planned_once
def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as postings to the customer's account from the next one. The last
    account's neighbour does not exist."""
    amount = _amount("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("oper_date"),
        F.col("o_custkey").alias("credit_account_rk"),
        (F.col("o_custkey") + 1).alias("debet_account_rk"),
        amount.alias("credit_amount"),
        (amount * F.lit(Decimal("0.75"))).cast(MONEY).alias("debet_amount"),
    )


@_planned_once
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances on the day before the history, some in a currency other
    than the account's, and suppliers' balances, which belong to no account."""
    day = F.lit(HISTORY.day_before)
    customers = table(spark, sf_dir, "customer").select(
        day.alias("on_date"),
        F.col("c_custkey").alias("account_rk"),
        (F.col("c_nationkey") + F.col("c_custkey") % 2).cast("long").alias("currency_rk"),
        _amount("c_acctbal").alias("balance_out"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        day.alias("on_date"),
        (F.col("s_suppkey") + 9000000000).alias("account_rk"),
        F.col("s_nationkey").cast("long").alias("currency_rk"),
        _amount("s_acctbal").alias("balance_out"),
    )
    return customers.unionByName(suppliers)


@_planned_once
def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deals. Urgent ones carry another product's name."""
    named = F.col("o_custkey") + F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("deal_rk"),
        F.concat(F.lit("№ "), F.col("o_orderkey").cast("string")).alias("deal_num"),
        F.concat(F.lit("Продукт "), named.cast("string")).alias("deal_name"),
        _kopecks("o_totalprice").cast("decimal(23,2)").alias("deal_sum"),
        F.col("o_custkey").alias("client_rk"),
        F.col("o_custkey").alias("account_rk"),
        (F.col("o_orderkey") + 1).alias("agreement_rk"),
        day.alias("deal_start_date"),
        (F.col("o_custkey") % 10).alias("department_rk"),
        F.col("o_custkey").alias("product_rk"),
        F.col("o_orderstatus").alias("deal_type_cd"),
        F.trunc(day, "year").alias("effective_from_date"),
        F.lit(FAR_FUTURE).alias("effective_to_date"),
    )


@_planned_once
def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as loan holidays of the deal version of their year."""
    day = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("deal_rk"),
        F.concat("l_returnflag", "l_linestatus").alias("loan_holiday_type_cd"),
        day.alias("loan_holiday_start_date"),
        F.date_add(day, F.col("l_linenumber") * 30).alias("loan_holiday_finish_date"),
        F.when(F.col("l_linenumber") > 1, F.date_add(day, F.col("l_linenumber"))).alias(
            "loan_holiday_fact_finish_date"
        ),
        F.when(F.col("l_quantity") > 25, "Y").otherwise("N").alias("loan_holiday_finish_flg"),
        F.date_add(day, 365).alias("loan_holiday_last_possible_date"),
        F.trunc(day, "year").alias("effective_from_date"),
        F.date_add(day, 1000).alias("effective_to_date"),
    )


@_planned_once
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products, one version per year to 2000. The smallest sizes come
    twice: once more as they are, or with another end."""
    year = F.explode(
        F.sequence(
            F.lit(date(1995, 1, 1)), F.lit(date(2000, 1, 1)), F.expr("interval 1 year")
        )
    )
    ends = F.explode(
        F.when(F.col("p_size") == 1, F.array(F.lit(FAR_FUTURE), F.lit(date(2049, 12, 31))))
        .when(F.col("p_size") == 2, F.array(F.lit(FAR_FUTURE), F.lit(FAR_FUTURE)))
        .otherwise(F.array(F.lit(FAR_FUTURE)))
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", "p_size", year.alias("effective_from_date"))
        .select("p_partkey", "effective_from_date", ends.alias("effective_to_date"))
        .select(
            F.col("p_partkey").alias("product_rk"),
            F.concat(F.lit("Продукт "), F.col("p_partkey").cast("string")).alias("product_name"),
            "effective_from_date",
            "effective_to_date",
        )
    )


@_planned_once
def account_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events summed by user and day as closing sums; the opening sums of every
    fourth user are one too high."""
    by_day = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").alias("account_rk"),
            F.col("ts").cast("date").alias("effective_date"),
        )
        .agg(F.sum(_kopecks("value")).cast(MONEY).alias("account_out_sum"))
    )
    last = F.lag("account_out_sum").over(
        Window.partitionBy("account_rk").orderBy("effective_date")
    )
    extra = F.when(F.col("account_rk") % 4 == 0, 1).otherwise(0)
    return by_day.select(
        "account_rk",
        "effective_date",
        (F.coalesce(last, F.lit(0)) + extra).cast(MONEY).alias("account_in_sum"),
        "account_out_sum",
    )


@_planned_once
def bank_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_rk"),
        F.col("c_nationkey").cast("long").alias("department_rk"),
        (100 + F.col("c_nationkey")).cast("string").alias("currency_cd"),
    )


@_planned_once
def currency_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        (103 + F.col("n_nationkey")).cast("string").alias("currency_cd"),
        F.col("n_name").alias("currency_name"),
    )


@_planned_once
def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client versions by month of order, with copies and missing statuses."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("client_rk"),
        F.trunc("o_orderdate", "month").alias("effective_from_date"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
    )
