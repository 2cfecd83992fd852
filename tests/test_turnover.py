import pytest
from pyspark.sql import functions as F

from daybook.functions import Period
from daybook.operators import dropped_legs, posting_legs, turnover
from helpers import BROADCAST, JAN, A, P, accounts, day, num, postings, rates, rows

PERIOD = Period(*JAN)


def test_leg_of_account_not_valid_that_day_is_dropped_alone(spark):
    acc = accounts(spark, (1, A, day(10), day(31)), (2, P, *JAN))
    post = postings(spark, (day(5), 1, 2, 10, 20), (day(12), 1, 2, 1, 2))
    result = turnover(post, acc, rates(spark), PERIOD)
    assert rows(result, "on_date", "account_rk", "credit_amount", "debet_amount") == [
        (day(12), 1, num(1), None),
        (day(12), 2, None, num(2)),
        (day(5), 2, None, num(20)),
    ]
    dropped = dropped_legs(post, acc, PERIOD)
    assert rows(dropped) == [(day(5), 1, 0, num(10), None)]


def test_dropped_and_kept_debit_amounts_add_up(spark):
    acc = accounts(spark, *[(k, A, day(1 + k), day(20 + k)) for k in range(8)])
    post = postings(
        spark, *[(day(1 + (i * 7) % 31), i % 9, (i * 5) % 10, i, i * 3) for i in range(200)]
    )
    total = post.agg(F.sum("debet_amount")).first()[0]
    kept = turnover(post, acc, rates(spark), PERIOD).agg(F.sum("debet_amount")).first()[0]
    lost = dropped_legs(post, acc, PERIOD).agg(F.sum("debet_amount")).first()[0]
    assert kept + lost == total


def test_missing_rate_counts_one_to_one(spark):
    acc = accounts(spark, (1, A, *JAN, 840), (2, A, *JAN, 978))
    post = postings(spark, (day(3), 1, 2, 10, 10))
    rate = rates(spark, (840, day(1), day(2), 99), (840, day(3), day(4), "57.60020000"))
    result = turnover(post, acc, rate, PERIOD)
    assert rows(result, "account_rk", "credit_amount_rub", "debet_amount_rub") == [
        (1, num("576.002"), None),
        (2, None, num(10)),
    ]


def test_rate_without_end_is_not_valid_any_day(spark):
    acc = accounts(spark, (1, A, *JAN, 840))
    post = postings(spark, (day(3), 1, 9, 10, 10))
    result = turnover(post, acc, rates(spark, (840, day(1), None, 50)), PERIOD)
    assert rows(result, "credit_amount_rub") == [(num(10),)]


def test_rubles_round_once_after_the_day_is_added_up(spark):
    acc = accounts(spark, (1, A, *JAN, 840))
    # Each posting alone gives ...5 in the ninth place and would round up.
    post = postings(
        spark, (day(3), 1, 9, "0.1", 0), (day(3), 1, 9, "0.1", 0), (day(3), 1, 9, "0.1", 0)
    )
    rate = rates(spark, (840, *JAN, "0.00000005"))
    result = turnover(post, acc, rate, PERIOD)
    assert rows(result, "credit_amount_rub") == [(num("0.00000002"),)]


def test_postings_outside_the_period_are_left_out(spark):
    acc = accounts(spark, (1, A, day(1, 1, 2017), day(31, 12)))
    post = postings(spark, (day(31, 12, 2017), 1, 1, 5, 5), (day(1, 2), 1, 1, 7, 7))
    assert rows(turnover(post, acc, rates(spark), PERIOD)) == []


def test_two_rates_on_one_day_count_twice(spark):
    acc = accounts(spark, (1, A, *JAN, 840))
    post = postings(spark, (day(3), 1, 9, 10, 0))
    rate = rates(spark, (840, day(1), day(9), 2), (840, day(3), day(9), 3))
    result = turnover(post, acc, rate, PERIOD)
    assert rows(result, "credit_amount", "credit_amount_rub") == [(num(20), num(50))]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_hot_account_and_currency_give_the_same_either_way(spark, threshold):
    spark.conf.set(BROADCAST, threshold)
    acc = accounts(spark, *[(k, A, *JAN, 34 if k < 40 else 840) for k in range(60)])
    post = postings(
        spark,
        *[(day(1 + i % 31), 1 if i % 3 == 0 else i % 60, (i * 7) % 60, i, i) for i in range(600)],
    )
    rate = rates(spark, (840, *JAN, "57.6"), (34, day(10), day(20), "2.5"))
    result = turnover(post, acc, rate, PERIOD)
    expected = {}
    for i in range(600):
        d = day(1 + i % 31)
        for side, k in ((0, 1 if i % 3 == 0 else i % 60), (1, (i * 7) % 60)):
            factor = num("57.6") if k >= 40 else num("2.5") if 10 <= d.day <= 20 else num(1)
            entry = expected.setdefault((d, k), [None, None, None, None])
            entry[2 * side] = (entry[2 * side] or 0) + num(i)
            entry[2 * side + 1] = (entry[2 * side + 1] or 0) + num(i) * factor
    got = {(r[0], r[1]): list(r[2:]) for r in result.collect()}
    assert got == expected


def test_postings_are_dealt_over_parts_before_they_are_added_up(spark):
    data = [(day(1 + i % 28), 1, 2 + i % 3, i, 1) for i in range(500)]
    legs = posting_legs(postings(spark, *data).coalesce(1), PERIOD)
    expected = {}
    for on, credit, debet, a, b in data:
        for account, side, x in ((credit, 0, a), (debet, 1, b)):
            expected.setdefault((on, account), [0, 0, 0, 0])
            expected[on, account][side] += x
            expected[on, account][2 + side] += 1
    found = {(r.on_date, r.account_rk): [r.credit_amount or 0, r.debet_amount or 0, r.credit_legs, r.debet_legs] for r in legs.collect()}
    assert found == expected
    # No sum below the first exchange, and all sums by account in parts of the account.
    plan = posting_legs(postings(spark, *data).coalesce(1), PERIOD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == plan.count("Exchange") == 2
    assert "HashAggregate" not in plan[plan.rindex("Exchange") :]
