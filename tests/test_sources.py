from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import (
    Period,
    fixed_scale_text,
    parse_date,
    parse_integer,
    parse_key,
    parse_number,
    text_message,
)
from daybook.plans import load_detail, typed_balances, typed_postings
from daybook.schemas import (
    DM_BALANCE,
    DEAL,
    FT_BALANCE,
    FT_POSTING,
    LEDGER_LOADED,
    MD_ACCOUNT,
    MD_CURRENCY,
    MD_EXCHANGE_RATE,
    MD_LEDGER_ACCOUNT,
    deal_table,
)
from daybook.session import scratch_path
from daybook.sources import overwrite_table, read_delimited, read_table, replace_days, write_delimited
from helpers import day, mart, num, rows


def write_lines(spark, lines, encoding="utf-8"):
    path = scratch_path(spark, "lines")
    (
        spark.createDataFrame([(line,) for line in lines], "value string")
        .coalesce(1)
        .write.option("encoding", encoding)
        .text(path)
    )
    return path


def test_delimited_text_is_read_as_text_and_typed(spark):
    path = write_lines(
        spark,
        ["ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT", "31.12.2017;36;034;38318.13", "31.12.2017;7;;5"],
    )
    raw = read_delimited(spark, path)
    assert set(dict(raw.dtypes).values()) == {"string"}
    typed = typed_balances(raw)
    assert [f.dataType for f in typed.schema] == [f.dataType for f in FT_BALANCE.schema]
    assert rows(typed) == sorted(
        [(day(31, 12, 2017), 36, 34, num("38318.13")), (day(31, 12, 2017), 7, None, num(5))],
        key=repr,
    )


def test_identical_postings_merge_only_when_asked(spark):
    line = "05-01-2018;1;2;10;10"
    path = write_lines(
        spark, ["OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT", line, line]
    )
    assert typed_postings(read_delimited(spark, path, dedupe=True)).count() == 1
    result = typed_postings(read_delimited(spark, path))
    assert rows(result) == [(day(5), 1, 2, num(10), num(10))] * 2
    assert result.columns == FT_POSTING.columns


def test_windows_code_page(spark):
    path = scratch_path(spark, "cp1251")
    text = "deal_rk,deal_num,deal_name\n1,№ 7,Кредит «Ёж»\n"
    as_latin = text.encode("windows-1251").decode("latin-1")
    spark.createDataFrame([(line,) for line in as_latin.splitlines()], "value string").coalesce(
        1
    ).select(F.encode("value", "iso-8859-1").alias("b")).select(
        F.decode("b", "iso-8859-1").alias("deal_rk")
    ).write.options(header=False, encoding="iso-8859-1", quote="", escapeQuotes=False, sep="\t").csv(
        path
    )
    schema = DEAL.schema
    df = read_delimited(
        spark,
        path,
        sep=",",
        schema=type(schema)(schema.fields[:3]),
        encoding="Windows-1251",
    )
    assert rows(df) == [(1, "№ 7", "Кредит «Ёж»")]
    with pytest.raises(ValueError):
        read_delimited(spark, path, encoding="gb18030")


def test_deal_sum_keeps_kopecks_unless_asked_otherwise(spark):
    path = write_lines(spark, [",".join(DEAL.columns), "1,a,b,1234.56" + "," * 9])
    wide = read_delimited(spark, path, sep=",", schema=DEAL.schema)
    assert wide.first().deal_sum == Decimal("1234.56")
    whole = deal_table(type(DEAL.schema["deal_sum"].dataType)(10, 0))
    assert read_delimited(spark, path, sep=",", schema=whole.schema).first().deal_sum == 1235


def one(spark, value):
    return spark.createDataFrame([(value,)], "x string")


@pytest.mark.parametrize(
    "value, parse",
    [
        ("31.02.2018", lambda: parse_date("x", "dd.MM.yyyy")),
        ("2018/01/01", lambda: parse_date("x")),
        ("12345678901", lambda: parse_key("x")),
        ("12a", lambda: parse_key("x")),
        ("1000", lambda: parse_integer("x", 3)),
        ("1,5", lambda: parse_number("x")),
    ],
)
def test_malformed_text_raises(spark, value, parse):
    with pytest.raises(PySparkException):
        one(spark, value).select(parse()).collect()
    assert one(spark, None).select(parse()).first()[0] is None


def test_text_forms(spark):
    row = one(spark, "1234567.1").select(
        fixed_scale_text(parse_number("x")),
        fixed_scale_text(F.lit(0).cast("decimal(23,8)")),
        fixed_scale_text(F.lit(None).cast("decimal(23,8)")),
        text_message("a ", F.lit(None), F.lit(day(1)), "!"),
    ).first()
    assert tuple(row) == ("1234567.10000000", "0.00000000", None, "a 2018-01-01!")


def test_month_arithmetic_clamps(spark):
    row = one(spark, "2018-03-31").select(
        F.add_months(parse_date("x"), -1), F.date_sub(parse_date("x"), 1)
    ).first()
    assert tuple(row) == (day(28, 2), day(30, 3))


def test_tables_and_replaced_days(spark):
    path = scratch_path(spark, "table")
    overwrite_table(mart(spark, (day(1), 1, 1, 1)), path)
    overwrite_table(mart(spark, (day(2), 2, 2, 2)), path)
    assert rows(read_table(spark, path)) == [(day(2), 2, num(2), num(2))]

    path = scratch_path(spark, "days")
    week = Period(day(1), day(7))
    replace_days(mart(spark, (day(1), 1, 1, 1), (day(2), 1, 1, 1)), path, week)
    replace_days(mart(spark, (day(9), 1, 9, 9)), path, Period(day(8), day(9)))
    replace_days(mart(spark, (day(2), 1, 5, 5)), path, week)
    stored = read_table(spark, path).select("on_date", "balance_out")
    assert rows(stored) == [(day(2), num(5)), (day(9), num(9))]


def test_stray_rows_raise_and_stored_days_stay(spark):
    path = scratch_path(spark, "days")
    week = Period(day(1), day(7))
    replace_days(mart(spark, (day(1), 1, 1, 1), (day(2), 1, 1, 1)), path, week)
    before = rows(read_table(spark, path))
    for stray in (day(8), None):
        with pytest.raises(PySparkException):
            replace_days(mart(spark, (day(3), 1, 5, 5), (stray, 1, 1, 1)), path, week)
        assert rows(read_table(spark, path)) == before
    replace_days(mart(spark), path, week)
    assert read_table(spark, path, schema=DM_BALANCE.schema).count() == 0


@pytest.mark.parametrize("line", ["1;x", "1", "1;2;3"])
def test_malformed_typed_lines_raise(spark, line):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("a;b",), ("5;6",), (line,)], "value string").coalesce(1).write.text(path)
    typed = read_delimited(spark, path, schema=T.StructType.fromDDL("a int, b int"))
    with pytest.raises(Exception, match="(?i)malformed"):
        typed.collect()


def test_detail_load_merges_dimensions_and_replaces_postings(spark):
    def text(columns, *data):
        return spark.createDataFrame(list(data), ", ".join(f"{c.upper()} string" for c in columns))

    def nothing(table):
        return spark.createDataFrame([], table.schema)

    old = dict.fromkeys(MD_LEDGER_ACCOUNT.columns)
    old.update(ledger_account=30102, start_date=day(1), chapter="Z", is_loan=1)
    current = {
        "md_account_d": nothing(MD_ACCOUNT),
        "md_currency_d": nothing(MD_CURRENCY),
        "md_exchange_rate_d": nothing(MD_EXCHANGE_RATE),
        "md_ledger_account_s": spark.createDataFrame(
            [tuple(old[c] for c in MD_LEDGER_ACCOUNT.columns)], MD_LEDGER_ACCOUNT.schema
        ),
        "ft_balance_f": spark.createDataFrame(
            [(day(31, 12, 2017), 1, 34, num(1)), (day(30, 12, 2017), 1, 34, num(9))],
            FT_BALANCE.schema,
        ),
    }
    new = dict.fromkeys(LEDGER_LOADED)
    new.update(ledger_account="30102", start_date="2018-01-01", chapter="А", section_number="3")
    raw = {
        "md_account_d": text(
            MD_ACCOUNT.columns, ("2018-01-01", "2018-01-31", "1", "30102", "А", "34", "810")
        ),
        "md_currency_d": text(MD_CURRENCY.columns, ("34", "2011-09-06", "2050-12-31", "000", None)),
        "md_exchange_rate_d": text(
            MD_EXCHANGE_RATE.columns, ("2018-01-01", "2018-01-01", "35", "57.6002", "840")
        ),
        "md_ledger_account_s": text(LEDGER_LOADED, tuple(new[c] for c in LEDGER_LOADED)),
        "ft_balance_f": text(FT_BALANCE.columns, ("31.12.2017", "1", "34", "5.5")),
        "ft_posting_f": text(FT_POSTING.columns, ("05-01-2018", "1", "2", "1", "2")),
    }
    loaded = load_detail(raw, current)
    assert rows(loaded["ft_balance_f"], "on_date", "balance_out") == [
        (day(30, 12, 2017), num(9)),
        (day(31, 12, 2017), num("5.5")),
    ]
    plan = loaded["md_ledger_account_s"].first()
    assert (plan.chapter, plan.section_number, plan.is_loan) == ("А", 3, 1)
    assert loaded["md_currency_d"].first().currency_code == "000"
    assert loaded["md_exchange_rate_d"].first().reduced_cource == num("57.6002")
    assert loaded["ft_posting_f"].count() == loaded["md_account_d"].count() == 1
