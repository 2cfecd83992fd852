import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException

from daybook.functions import Period
from daybook.operators import balances, opening_balances, turnover
from helpers import BROADCAST, JAN, A, P, accounts, day, mart, num, postings, rates, rows, snapshot

PERIOD = Period(*JAN)
BEFORE = PERIOD.day_before


def carried(spark, acc, post, opening, period=PERIOD, days="all"):
    moves = turnover(post, acc, rates(spark), period)
    return balances(acc, moves, opening, period, days=days)


def by_day(df, account):
    return {
        r.on_date: r.balance_out for r in df.where(f"account_rk = {account}").collect()
    }


def test_active_and_passive_accounts_move_in_opposite_directions(spark):
    acc = accounts(spark, (1, A, *JAN), (2, P, *JAN), (3, "A", *JAN))
    post = postings(spark, (day(2), 1, 2, 5, 7), (day(3), 3, 3, 1, 2))
    opening = mart(spark, (BEFORE, 1, 100, 100), (BEFORE, 2, 50, 50), (BEFORE, 3, 9, 9))
    result = carried(spark, acc, post, opening)
    assert result.count() == 3 * 31
    first, second = by_day(result, 1), by_day(result, 2)
    assert (first[day(1)], first[day(2)], first[day(31)]) == (num(100), num(95), num(95))
    assert (second[day(1)], second[day(2)]) == (num(50), num(43))
    # A Latin letter is neither type.
    assert set(by_day(result, 3).values()) == {num(9)}


def test_gap_in_validity_restarts_from_zero(spark):
    acc = accounts(spark, (1, A, day(1), day(10)), (1, A, day(15), day(31)))
    post = postings(spark, (day(2), 9, 1, 0, 5), (day(20), 9, 1, 0, 3))
    result = by_day(carried(spark, acc, post, mart(spark, (BEFORE, 1, 100, 100))), 1)
    assert day(12) not in result
    assert (result[day(10)], result[day(15)], result[day(31)]) == (num(105), num(0), num(3))


def test_adjoining_version_carries_on_with_its_own_sign(spark):
    acc = accounts(spark, (1, A, day(1), day(10)), (1, P, day(11), day(31)))
    post = postings(spark, (day(10), 9, 1, 0, 5), (day(11), 9, 1, 0, 2), (day(12), 9, 1, 0, 1))
    result = by_day(carried(spark, acc, post, mart(spark, (BEFORE, 1, 10, 10))), 1)
    assert [result[day(d)] for d in (9, 10, 11, 12)] == [num(10), num(15), num(13), num(12)]


def test_account_opened_in_mid_month_ignores_an_opening_balance(spark):
    acc = accounts(spark, (1, A, day(15), day(31)))
    result = by_day(carried(spark, acc, postings(spark), mart(spark, (BEFORE, 1, 8, 8))), 1)
    assert min(result) == day(15) and set(result.values()) == {num(0)}


def test_opening_uses_the_snapshots_currency_and_the_day_before_rate(spark):
    acc = accounts(spark, (1, A, *JAN, 840), (2, A, day(2), day(31)), (3, A, *JAN))
    snap = snapshot(
        spark,
        (BEFORE, 1, 978, 10),
        (BEFORE, 2, 34, 10),
        (BEFORE, 3, 34, 10),
        (BEFORE, 4, 34, 10),
        (day(30, 12, 2017), 3, 34, 99),
    )
    rate = rates(spark, (978, day(1, 12, 2017), BEFORE, 70), (978, day(1), day(31), 80),
                 (840, day(1, 12, 2017), day(31), 60))
    for threshold in ("-1", "10m"):
        spark.conf.set(BROADCAST, threshold)
        result = opening_balances(snap, acc, rate, PERIOD)
        assert rows(result) == [
            (BEFORE, 1, num(10), num(700)),
            (BEFORE, 3, num(10), num(10)),
        ]


@pytest.mark.parametrize(
    "versions",
    [
        [(1, A, day(1), day(10)), (1, A, day(10), day(31))],
        [(1, A, day(1), day(31)), (1, A, day(5), day(6))],
        [(1, A, day(1), day(31)), (1, A, day(1), day(31))],
        [(1, A, day(1, 12, 2017), day(31)), (1, A, day(2, 12, 2017), day(31))],
    ],
)
def test_overlapping_versions_raise(spark, versions):
    acc = accounts(spark, *versions)
    with pytest.raises(PySparkException, match="overlapping versions"):
        carried(spark, acc, postings(spark, (day(3), 9, 1, 0, 5)), mart(spark)).count()


def test_repeated_opening_raises(spark):
    opening = mart(spark, (BEFORE, 1, 1, 1), (BEFORE, 1, 2, 2))
    with pytest.raises(PySparkException, match="repeated rows"):
        carried(spark, accounts(spark, (1, A, *JAN)), postings(spark), opening).count()


def random_case(seed):
    pick = random.Random(seed)
    start = date(2017, 12, 20)
    versions, moves, opening = [], {}, {}
    for account in range(12):
        at = start + timedelta(days=pick.randrange(0, 30))
        for _ in range(pick.randrange(1, 5)):
            end = at + timedelta(days=pick.randrange(0, 15))
            versions.append((account, pick.choice([A, P, "x"]), at, end))
            at = end + timedelta(days=pick.choice([1, 1, 2, 5]))
        if pick.random() < 0.7:
            opening[account] = pick.randrange(-50, 50)
    for _ in range(150):
        key = (date(2018, 1, pick.randrange(1, 32)), pick.randrange(0, 13))
        credit, debit = moves.get(key, (0, 0))
        moves[key] = (credit + pick.randrange(0, 9), debit + pick.randrange(0, 9))
    return versions, moves, opening


def day_by_day(versions, moves, opening, period):
    """The recurrence itself: today from yesterday."""
    result, yesterday = {}, dict(opening)
    today = period.start
    while today <= period.end:
        current = {}
        for account, kind, start, end in versions:
            if start <= today <= end:
                credit, debit = moves.get((today, account), (0, 0))
                sign = {A: 1, P: -1}.get(kind, 0)
                current[account] = yesterday.get(account, 0) + sign * (debit - credit)
        result.update({(today, k): num(v) for k, v in current.items()})
        yesterday, today = current, today + timedelta(days=1)
    return result


@pytest.mark.parametrize("seed", range(6))
def test_same_as_day_by_day(spark, seed):
    versions, moves, opening = random_case(seed)
    acc = accounts(spark, *versions)
    post = postings(
        spark,
        *[(d, k, 99, credit, 0) for (d, k), (credit, _) in moves.items()],
        *[(d, 99, k, 0, debit) for (d, k), (_, debit) in moves.items()],
    )
    seeds = mart(spark, *[(BEFORE, k, v, 2 * v) for k, v in opening.items()])
    result = carried(spark, acc, post, seeds)
    expected = day_by_day(versions, moves, opening, PERIOD)
    got = {(r.on_date, r.account_rk): r.balance_out for r in result.collect()}
    assert got == expected
    ends = carried(spark, acc, post, seeds, days="month_ends")
    assert {(r.on_date, r.account_rk): r.balance_out for r in ends.collect()} == {
        k: v for k, v in expected.items() if k[0] == day(31)
    }
