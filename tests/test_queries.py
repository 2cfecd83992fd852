"""Registered queries against their SQL on the smallest shared tables.

By default a few of each kind; set ``ALL_QUERIES=1`` for every one.
"""

import os

import pytest

import __spark_entry__
from checks.compare import differences
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SOME = (
    "turnover_daily",
    "form101",
    "typed_load_code_page",
    "keyed_upsert",
    "append_new_rows",
    "contract_violations",
    "duplicate_key_rows",
    "loan_holiday_mart",
    "account_balance_turnover",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables absent")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize(
    "name", list(QUERIES) if os.environ.get("ALL_QUERIES") else SOME
)
def test_same_rows_as_sql(spark, name):
    assert differences(spark, SF_DIR, name) == []


def test_month_close_stores_every_period(spark):
    found = QUERIES["month_close_stored"](spark, SF_DIR).select("on_date").distinct().collect()
    days = {r.on_date for r in found}
    assert {(d.year, d.month) for d in days} == {(1995, m) for m in range(1, 13)} | {(1996, m) for m in range(1, 5)}
    assert len(days) == 31 + 28 + 31 + 10 + 29 + 31 + 30


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
