import re
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daybook.functions import Period, month_of_report
from daybook.operators import form101, form101_table, form101_text, replace_slice
from daybook.plans import close_month, export_form101, publish_month
from daybook.schemas import DM_FORM101, FORM101_MEASURES
from daybook.session import scratch_path
from daybook.sources import read_form101_csv
from helpers import BROADCAST, JAN, A, P, accounts, day, ledger, mart, num, postings, rates, rows, snapshot

PERIOD = Period(*JAN)
BEFORE = PERIOD.day_before
LONG = (day(1, 1, 2010), day(31, 12, 2050))
HEAD = ["ledger_account", "characteristic"]


def test_report_date_is_the_first_of_the_next_month():
    assert month_of_report(day(1, 2)) == PERIOD
    with pytest.raises(ValueError):
        month_of_report(day(2, 2))
    with pytest.raises(ValueError):
        Period(day(2), day(31)).month_ends()


def case(spark):
    acc = accounts(
        spark,
        (1, A, *LONG, 34, "810", "30102" + "0" * 15),
        (2, P, *LONG, 34, "643", "30102" + "1" * 15),
        (3, A, *LONG, 840, "840", "30102" + "2" * 15),
        (4, A, day(2), day(31), 34, "810", "30102" + "3" * 15),
        (5, A, *LONG, 34, "810", "40502" + "0" * 15),
        (6, A, *LONG, 34, "810", "99999" + "0" * 15),
    )
    plan = ledger(spark, (30102, "А", *LONG), (40502, "А", day(1), day(30)))
    post = postings(spark, (day(5), 1, 3, 10, 2), (day(9), 2, 4, 4, 4))
    rate = rates(spark, (840, day(1, 12, 2017), day(31), 60))
    snap = snapshot(spark, (BEFORE, 1, 34, 100), (BEFORE, 3, 840, 1), (BEFORE, 5, 34, 5))
    return acc, plan, post, rate, snap


def test_report_of_a_month(spark):
    acc, plan, post, rate, snap = case(spark)
    close = close_month(post, acc, rate, snap, PERIOD)
    for threshold in ("-1", "10m"):
        spark.conf.set(BROADCAST, threshold)
        report = form101(acc, plan, close.turnover, close.balances, PERIOD)
        # Two account types give two rows; a ledger account not valid all month, an
        # account opened in mid-month and an unknown ledger account give none.
        assert rows(report, *HEAD) == sorted([("30102", A), ("30102", P)], key=repr)
        active = report.where(F.col("characteristic") == A).first()
        assert [active[c] for c in FORM101_MEASURES] == [
            num(x) for x in (100, 60, 160, 0, 120, 120, 10, 0, 10, 90, 180, 270)
        ]
        passive = report.where(F.col("characteristic") == P).first()
        assert (passive.balance_in_total, passive.turn_cre_rub) == (num(0), num(4))
        assert (report.first().from_date, report.first().to_date) == JAN


def test_in_plus_turnover_is_out(spark):
    acc, plan, post, rate, snap = case(spark)
    close = close_month(post, acc, rate, snap, PERIOD)
    for r in form101(acc, plan, close.turnover, close.balances, PERIOD).collect():
        sign = 1 if r.characteristic == A else -1
        for part in ("rub", "val", "total"):
            moved = r[f"turn_deb_{part}"] - r[f"turn_cre_{part}"]
            assert r[f"balance_out_{part}"] == r[f"balance_in_{part}"] + sign * moved
        for name in ("balance_in", "turn_deb", "turn_cre", "balance_out"):
            assert r[f"{name}_total"] == r[f"{name}_rub"] + r[f"{name}_val"]


def test_group_without_balances_is_null_on_its_own_side_only(spark):
    acc, plan, post, rate, _ = case(spark)
    close = close_month(post, acc, rate, snapshot(spark), PERIOD)
    report = form101(acc, plan, close.turnover, mart(spark), PERIOD)
    r = report.where(F.col("characteristic") == P).first()
    assert (r.balance_in_rub, r.balance_in_val, r.balance_in_total) == (None, num(0), None)
    assert (r.turn_deb_total, r.turn_cre_total) == (num(0), num(4))


def test_many_months_at_once_are_the_months_one_by_one(spark):
    acc, plan, post, rate, snap = case(spark)
    post = post.unionByName(postings(spark, (day(3, 2), 1, 3, 7, 7), (day(28, 2), 3, 2, 1, 1)))
    whole = Period(day(1), day(31, 3))
    close = close_month(post, acc, rate, snap, whole)
    together = form101(acc, plan, close.turnover, close.balances, whole)
    singly = [
        form101(acc, plan, close.turnover, close.balances, month_of_report(day(1, m)))
        for m in (2, 3, 4)
    ]
    assert rows(together) == sorted((r for one in singly for r in rows(one)), key=repr)
    assert together.count() == 6


def test_export_and_reading_back(spark):
    acc, plan, post, rate, snap = case(spark)
    close = close_month(post, acc, rate, snap, PERIOD)
    path = scratch_path(spark, "form")
    export_form101(acc, plan, close, path)
    lines = {r.value for r in spark.read.text(path).collect()}
    assert ";".join(DM_FORM101.columns) in lines
    assert any("0.00000000;;" in line and "E" not in line for line in lines if A in line)
    table = form101_table(form101(acc, plan, close.turnover, close.balances, PERIOD))
    assert rows(read_form101_csv(spark, path)) == rows(table)
    assert dict(form101_text(table).dtypes)["turn_deb_val"] == "string"


def test_second_close_from_snapshot_or_from_the_first_close(spark):
    acc, _, post, rate, snap = case(spark)
    post = post.unionByName(postings(spark, (day(3, 2), 1, 3, 7, 7)))
    february = Period(day(1, 2), day(28, 2))
    turnover_mart, balance_mart = close_month(post, acc, rate, snap, PERIOD).into(
        spark.createDataFrame([], close_month(post, acc, rate, snap, PERIOD).turnover.schema),
        mart(spark),
    )
    closing = {
        r.account_rk: r.balance_out
        for r in balance_mart.where(F.col("on_date") == F.lit(day(31))).collect()
    }
    assert closing[1] == num(90)

    again = close_month(
        post, acc, rate, snap, february, opening="previous_close", balance_mart=balance_mart
    )
    _, carried = again.into(turnover_mart, balance_mart)
    first = {r.on_date: r.balance_out for r in carried.where("account_rk = 1").collect()}
    assert (first[day(31)], first[day(1, 2)], first[day(3, 2)]) == (num(90), num(90), num(83))

    # From the snapshot, of which there is none for that day: the day before is
    # emptied and the chain begins at zero.
    seeded = close_month(post, acc, rate, snap, february)
    _, restarted = seeded.into(turnover_mart, balance_mart)
    first = {r.on_date: r.balance_out for r in restarted.where("account_rk = 1").collect()}
    assert day(31) not in first and first[day(30)] == num(90)
    assert (first[day(1, 2)], first[day(3, 2)]) == (num(0), num(-7))

    with pytest.raises(ValueError):
        close_month(post, acc, rate, snap, february, opening="previous_close")


def test_published_marts_equal_the_computed_ones_and_rerun_changes_nothing(spark):
    acc, plan, post, rate, snap = case(spark)
    turnover_path, balance_path = scratch_path(spark, "t"), scratch_path(spark, "b")
    close = close_month(post, acc, rate, snap, PERIOD)
    for _ in range(2):
        stored = publish_month(post, acc, rate, snap, PERIOD, turnover_path, balance_path)
        assert rows(stored.turnover) == rows(close.turnover)
        whole_mart = spark.read.parquet(balance_path)
        report = form101(acc, plan, stored.turnover, whole_mart, PERIOD)
        physical = report._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: [^\]]*on_date#\d+ IN", physical)
        assert rows(stored.balances) == rows(close.balances)
    # All postings of a day gone: the day is empty after a new close.
    fewer = post.where(F.col("oper_date") != F.lit(day(9)))
    stored = publish_month(fewer, acc, rate, snap, PERIOD, turnover_path, balance_path)
    assert {r.on_date for r in stored.turnover.collect()} == {day(5)}
    february = Period(day(1, 2), day(28, 2))
    more = fewer.unionByName(postings(spark, (day(2, 2), 1, 3, 1, 1)))
    after = publish_month(
        more, acc, rate, snap, february, turnover_path, balance_path, "previous_close"
    )
    assert {r.on_date for r in after.turnover.collect()} == {date(2018, 2, 2)}
    kept = spark.read.parquet(balance_path).where(F.col("on_date") <= F.lit(day(31)))
    assert kept.count() == stored.balances.count()


def test_failed_close_leaves_the_stored_month(spark):
    acc, _, post, rate, snap = case(spark)
    paths = scratch_path(spark, "t"), scratch_path(spark, "b")
    publish_month(post, acc, rate, snap, PERIOD, *paths)
    before = [rows(spark.read.parquet(p)) for p in paths]
    with pytest.raises(PySparkException):
        publish_month(post, acc.unionByName(acc), rate, snap, PERIOD, *paths)
    assert [rows(spark.read.parquet(p)) for p in paths] == before


def test_rerun_of_a_slice_changes_nothing(spark):
    acc, _, post, rate, snap = case(spark)
    close = close_month(post, acc, rate, snap, PERIOD)
    old = mart(spark, (None, 1, 5, 5), (day(3), 77, 1, 1), (day(3, 2), 1, 6, 6))
    once = replace_slice(old, close.balances_from.contains("on_date"), close.balances)
    twice = replace_slice(once, close.balances_from.contains("on_date"), close.balances)
    assert rows(once) == rows(twice)
    assert 77 not in {r.account_rk for r in once.collect()}
    emptied = replace_slice(once, PERIOD.contains("on_date"), mart(spark))
    assert {r.on_date for r in emptied.collect()} == {None, BEFORE, day(3, 2)}


def test_month_without_postings_or_accounts(spark):
    acc, plan, _, rate, snap = case(spark)
    paths = scratch_path(spark, "t"), scratch_path(spark, "b")
    stored = publish_month(postings(spark), acc, rate, snap, PERIOD, *paths)
    assert stored.turnover.count() == 0
    assert stored.balances.where(F.col("on_date") == F.lit(day(31))).count() == 6
    empty = scratch_path(spark, "t"), scratch_path(spark, "b")
    stored = publish_month(postings(spark), accounts(spark), rate, snap, PERIOD, *empty)
    assert form101(accounts(spark), plan, stored.turnover, stored.balances, PERIOD).count() == 0
