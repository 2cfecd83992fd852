from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from daybook.operators import (
    account_balance_turnover,
    in_sum_corrections,
    loan_holiday_mart,
    out_sum_corrections,
    preview,
    repair_in_sums,
)
from daybook.plans import refresh_loans
from daybook.schemas import ACCOUNT_BALANCE, DEAL, LOAN_HOLIDAY, PRODUCT
from helpers import BROADCAST, day, num, rows

D1, D2, FAR = day(1), day(1, 2), day(31, 12, 2050)


def deals(spark, *data):
    """(deal, product, name, from)"""
    full = [
        (rk, f"N{rk}", name, Decimal("1234.56"), 5, 6, 7, D1, 8, product, "T", start, FAR)
        for rk, product, name, start in data
    ]
    return spark.createDataFrame(full, DEAL.schema)


def holidays(spark, *data):
    """(deal, type, from, to)"""
    full = [(rk, kind, D1, D2, None, "N", D2, start, end) for rk, kind, start, end in data]
    return spark.createDataFrame(full, LOAN_HOLIDAY.schema)


def products(spark, *data):
    return spark.createDataFrame(list(data), PRODUCT.schema)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_loan_holiday_mart(spark, threshold):
    spark.conf.set(BROADCAST, threshold)
    deal = deals(spark, (1, 10, "loan", D1), (2, 10, "other", D1), (3, None, None, D1), (4, 20, "x", D1))
    holiday = holidays(spark, (1, "H", D1, day(9)), (1, "H2", D2, day(9)), (4, "H", D1, D2))
    product = products(
        spark,
        (10, "loan", D1, FAR),
        (10, "loan", D1, FAR),
        (20, "x", D1, FAR),
        (20, "x", D1, day(9)),
        (20, "x", D2, FAR),
    )
    result = loan_holiday_mart(deal, holiday, product)
    columns = ["deal_rk", "effective_from_date", "effective_to_date", "product_name",
               "loan_holiday_type_cd", "deal_sum"]
    cost = deal.first().deal_sum
    assert rows(result, *columns) == sorted(
        [
            (1, D1, day(9), "loan", "H", cost),
            (2, None, None, None, None, cost),
            (3, None, None, None, None, cost),
            # Two product versions that differ in their end repeat the deal.
            (4, D1, D2, "x", "H", cost),
            (4, D1, D2, "x", "H", cost),
        ],
        key=repr,
    )


def test_refresh_appends_only_new_deals(spark):
    old = deals(spark, (1, 10, "a", D1))
    new = deals(spark, (1, 10, "a", D1), (2, 10, "b", D1), (2, 10, "b", D1))
    product = products(spark, (10, "a", D1, FAR), (10, "a", D1, FAR))
    kept, all_deals, mart = refresh_loans(product, new, old, holidays(spark))
    assert (kept.count(), all_deals.count(), mart.count()) == (1, 2, 2)


def balances(spark, *data):
    return spark.createDataFrame(
        [(rk, d, num(x), num(y)) for rk, d, x, y in data], ACCOUNT_BALANCE.schema
    )


def test_opening_sums_follow_stored_closing_sums(spark):
    df = balances(
        spark,
        (1, day(1), 5, 10),
        (1, day(2), 11, 20),  # differs from 10
        (1, day(5), 21, 30),  # differs from 20, whatever the row above becomes
        (2, day(1), 7, None),
        (2, day(2), 3, 4),  # previous closing unknown
        (2, day(3), None, 9),  # own opening unknown
        (2, day(4), 9, 9),
    )
    corrected = in_sum_corrections(df)
    assert corrected.columns == [*df.columns, "correct_account_in_sum"]
    assert rows(repair_in_sums(df)) == rows(
        balances(
            spark,
            (1, day(1), 5, 10),
            (1, day(2), 10, 20),
            (1, day(5), 20, 30),
            (2, day(1), 7, None),
            (2, day(2), 3, 4),
            (2, day(3), None, 9),
            (2, day(4), 9, 9),
        )
    )
    assert rows(repair_in_sums(repair_in_sums(df))) == rows(repair_in_sums(df))


def test_closing_sums_follow_the_next_opening(spark):
    df = balances(spark, (1, day(1), 5, 10), (1, day(2), 11, 20), (2, day(1), 1, 1))
    assert rows(out_sum_corrections(df), "account_rk", "correct_account_out_sum") == [
        (1, num(11)),
        (1, num(20)),
        (2, num(1)),
    ]


def test_repeated_date_raises(spark):
    df = balances(spark, (1, day(1), 5, 10), (1, day(1), 11, 20))
    with pytest.raises(PySparkException, match="repeated effective_date"):
        repair_in_sums(df).collect()


def test_preview_is_ordered_and_short(spark):
    df = balances(spark, *[(k, day(1), 0, 0) for k in range(60, 0, -1)])
    assert [r.account_rk for r in preview(df, ["account_rk"]).collect()] == list(range(1, 41))


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_account_balance_turnover(spark, threshold):
    spark.conf.set(BROADCAST, threshold)
    accounts = spark.createDataFrame(
        [(1, 9, "810"), (2, 9, "999"), (3, 9, None)],
        "account_rk long, department_rk long, currency_cd string",
    )
    names = spark.createDataFrame([("810", "RUB")], "currency_cd string, currency_name string")
    df = balances(spark, (1, day(1), 0, 1), (1, day(2), 1, 2), (3, day(1), 0, 3))
    result = account_balance_turnover(accounts, df, names)
    assert rows(result) == sorted(
        [
            (1, "RUB", 9, day(1), num(0), num(1)),
            (1, "RUB", 9, day(2), num(1), num(2)),
            (2, "-1", 9, None, None, None),
            (3, "-1", 9, day(1), num(0), num(3)),
        ],
        key=repr,
    )


def test_product_versions_are_not_sent_whole(spark):
    spark.conf.set(BROADCAST, "10m")
    deal, holiday = deals(spark, (1, 10, "loan", D1)), holidays(spark, (1, "H", D1, day(9)))
    few = spark.createDataFrame([(10,)], "product_rk long")
    # A million versions that Spark takes for one row, as they are made on reading.
    many = few.selectExpr(
        "product_rk", "explode(sequence(1, 1000000)) AS n"
    ).selectExpr("product_rk", "concat('loan', n) AS product_name", "date'2018-01-01' AS effective_from_date", "date'2050-12-31' AS effective_to_date")
    plan = loan_holiday_mart(deal, holiday, many)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "product_rk" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
