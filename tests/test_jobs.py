import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daybook import sources
from daybook.jobs import main
from daybook.schemas import ACCOUNT_BALANCE, DEAL, LOAN_HOLIDAY, PRODUCT
from daybook.session import scratch_path
from helpers import A, day, num, rows

HEADERS = {
    "md_account_d": "DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;ACCOUNT_RK;ACCOUNT_NUMBER;CHAR_TYPE;"
    "CURRENCY_RK;CURRENCY_CODE",
    "md_currency_d": "CURRENCY_RK;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_CODE;CODE_ISO_CHAR",
    "md_exchange_rate_d": "DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_RK;REDUCED_COURCE;"
    "CODE_ISO_NUM",
    "md_ledger_account_s": "CHAPTER;CHAPTER_NAME;SECTION_NUMBER;SECTION_NAME;SUBSECTION_NAME;"
    "LEDGER1_ACCOUNT;LEDGER1_ACCOUNT_NAME;LEDGER_ACCOUNT;LEDGER_ACCOUNT_NAME;CHARACTERISTIC;"
    "START_DATE;END_DATE",
    "ft_balance_f": "ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT",
    "ft_posting_f": "OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT",
}
LINES = {
    "md_account_d": ["2018-01-01;2018-03-31;1;30102810000000000001;А;34;810"],
    "md_currency_d": ["34;2011-09-06;2050-12-31;810;RUB"],
    "md_exchange_rate_d": ["2018-01-01;2018-01-31;35;57.6;840"],
    "md_ledger_account_s": ["А;Балансовые счета;3;x;y;301;z;30102;w;А;2008-01-01;2050-12-31"],
    "ft_balance_f": ["31.12.2017;1;34;100.5"],
    "ft_posting_f": ["05-01-2018;1;9;10;10", "06-01-2018;9;1;3;3", "05-02-2018;1;9;1;1"],
}


def test_load_close_report_and_import(spark):
    base = scratch_path(spark, "jobs")
    for name, header in HEADERS.items():
        lines = [(line,) for line in [header, *LINES[name]]]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{base}/raw/{name}.csv")
    main(["load-detail", "--raw", f"{base}/raw", "--output", f"{base}/ds"])
    main(["check-detail", "--detail", f"{base}/ds"])
    place = ["--detail", f"{base}/ds", "--marts", f"{base}/dm", "--log", f"{base}/logs"]
    for report_date, opening in (("2018-02-01", "snapshot"), ("2018-03-01", "previous_close")):
        main(["close-month", "--report-date", report_date, *place, "--opening", opening])
        main(["report", "--report-date", report_date, *place, "--csv", f"{base}/csv-{report_date}"])
    main(["import-report", "--csv", f"{base}/csv-2018-03-01", "--output", f"{base}/v2"])
    months = sources.read_table(spark, f"{base}/v2")
    assert rows(months, "from_date") == [(day(1),), (day(1, 2),)]
    imported = months.where(F.col("from_date") == F.lit(day(1, 2))).first()
    assert imported.balance_in_rub == num("93.5") and imported.balance_out_rub == num("92.5")
    stored = sources.read_table(spark, f"{base}/dm/dm_f101_round_f")
    assert rows(stored, "from_date", "balance_out_total") == [
        (day(1), num("93.5")),
        (day(1, 2), num("92.5")),
    ]
    log = {r.log_message for r in spark.read.parquet(f"{base}/logs").collect()}
    assert {"turnover 2018-01-05: 1 rows", "form 101 2018-01-01: 1 rows"} <= log
    assert imported.characteristic == A
    assert {"close-month: start", "report: end"} <= log
    with pytest.raises(PySparkException):
        main(["close-month", "--report-date", "2018-02-01", *place[:-2], "--detail", f"{base}/none", "--log", f"{base}/logs"])
    failed = spark.read.parquet(f"{base}/logs").where("log_type = 'error'").collect()
    assert len(failed) == 1 and failed[0].log_message.startswith("close-month: ")
    assert "legs of accounts not valid 2018-01-05: 1 rows" in log


def test_clients_loans_and_repair(spark):
    base = scratch_path(spark, "jobs")
    clients = spark.createDataFrame(
        [(1, day(1), "a"), (1, day(1), "a"), (1, day(1), "b")],
        "client_rk long, effective_from_date date, name string",
    )
    sources.overwrite_table(clients, f"{base}/client")
    main(["clean-clients", "--table", f"{base}/client", "--output", f"{base}/client-clean"])
    assert sources.read_table(spark, f"{base}/client-clean").count() == 2

    deal = spark.createDataFrame([], DEAL.schema)
    sources.overwrite_table(deal, f"{base}/rd/deal_info")
    holiday = (7, "H", day(1), day(2), None, "N", day(3), day(1), day(9))
    sources.overwrite_table(
        spark.createDataFrame([holiday], LOAN_HOLIDAY.schema), f"{base}/rd/loan_holiday"
    )
    product = "10,loan,2018-01-01,2050-12-31"
    line = "7,N7,loan,99.50,1,2,3,2018-01-01,4,10,T,2018-01-01,2050-12-31"
    for name, table, text in (("products", PRODUCT, product), ("deals", DEAL, line)):
        spark.createDataFrame(
            [(x,) for x in (",".join(table.columns), text)], "value string"
        ).coalesce(1).write.text(f"{base}/raw/{name}.csv")
    files = ["--products", f"{base}/raw/products.csv", "--deals", f"{base}/raw/deals.csv"]
    main(["refresh-loans", *files, "--current", f"{base}/rd", "--output", f"{base}/rd2"])
    mart = sources.read_table(spark, f"{base}/rd2/loan_holiday_info").first()
    assert (mart.product_name, mart.loan_holiday_type_cd) == ("loan", "H")

    balance = [(1, day(1), num(0), num(5)), (1, day(2), num(4), num(6))]
    sources.overwrite_table(
        spark.createDataFrame(balance, ACCOUNT_BALANCE.schema), f"{base}/rd/account_balance"
    )
    account = spark.createDataFrame(
        [(1, 2, "810")], "account_rk long, department_rk long, currency_cd string"
    )
    sources.overwrite_table(account, f"{base}/rd/account")
    names = account.select("currency_cd", F.lit("RUB").alias("currency_name"))
    sources.overwrite_table(names, f"{base}/rd/dict_currency")
    main(["repair-balances", "--tables", f"{base}/rd", "--output", f"{base}/rd3"])
    repaired = sources.read_table(spark, f"{base}/rd3/account_balance_turnover")
    assert rows(repaired, "account_in_sum") == [(num(0),), (num(5),)]
