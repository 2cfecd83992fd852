"""Table contracts: column types, keys, required columns, text lengths.

Surrogate keys (``*_rk``) are ten-digit numbers and are held as ``long``.
Amounts are ``decimal(23,8)`` and rates ``decimal(14,8)``, so amount x rate is
``decimal(38,16)``: Spark keeps every digit of the product.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEY = T.LongType()
INT = T.IntegerType()
TEXT = T.StringType()
DATE = T.DateType()
MONEY = T.DecimalType(23, 8)
RATE = T.DecimalType(14, 8)

# Fixed values. The account types are Cyrillic letters; a Latin look-alike
# means neither type.
ACTIVE = "А"
PASSIVE = "П"
RUBLE_CODES = ("810", "643")

# The twelve measures of form 101, in report order. In the report
# table each is followed by an ``r_`` twin which stays empty.
FORM101_MEASURES = (
    "balance_in_rub",
    "balance_in_val",
    "balance_in_total",
    "turn_deb_rub",
    "turn_deb_val",
    "turn_deb_total",
    "turn_cre_rub",
    "turn_cre_val",
    "turn_cre_total",
    "balance_out_rub",
    "balance_out_val",
    "balance_out_total",
)


@dataclass(frozen=True)
class Table:
    """One table's contract. ``interval`` names the validity start and end;
    versions of one entity (the key without the start) must not overlap."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    interval: tuple[str, str] | None = None
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


FT_BALANCE = Table(
    "ft_balance_f",
    _struct(
        ("on_date", DATE),
        ("account_rk", KEY),
        ("currency_rk", KEY),
        ("balance_out", MONEY),
    ),
    key=("on_date", "account_rk"),
    required=("on_date", "account_rk"),
)

FT_POSTING = Table(
    "ft_posting_f",
    _struct(
        ("oper_date", DATE),
        ("credit_account_rk", KEY),
        ("debet_account_rk", KEY),
        ("credit_amount", MONEY),
        ("debet_amount", MONEY),
    ),
    required=("oper_date", "credit_account_rk", "debet_account_rk"),
)

MD_ACCOUNT = Table(
    "md_account_d",
    _struct(
        ("data_actual_date", DATE),
        ("data_actual_end_date", DATE),
        ("account_rk", KEY),
        ("account_number", TEXT),
        ("char_type", TEXT),
        ("currency_rk", KEY),
        ("currency_code", TEXT),
    ),
    key=("data_actual_date", "account_rk"),
    required=(
        "data_actual_date",
        "data_actual_end_date",
        "account_rk",
        "account_number",
        "char_type",
        "currency_rk",
        "currency_code",
    ),
    interval=("data_actual_date", "data_actual_end_date"),
    max_length={"account_number": 20, "char_type": 1, "currency_code": 3},
)

MD_CURRENCY = Table(
    "md_currency_d",
    _struct(
        ("currency_rk", KEY),
        ("data_actual_date", DATE),
        ("data_actual_end_date", DATE),
        ("currency_code", TEXT),
        ("code_iso_char", TEXT),
    ),
    key=("currency_rk", "data_actual_date"),
    required=("currency_rk", "data_actual_date"),
    interval=("data_actual_date", "data_actual_end_date"),
    max_length={"currency_code": 3, "code_iso_char": 3},
)

MD_EXCHANGE_RATE = Table(
    "md_exchange_rate_d",
    _struct(
        ("data_actual_date", DATE),
        ("data_actual_end_date", DATE),
        ("currency_rk", KEY),
        ("reduced_cource", RATE),
        ("code_iso_num", TEXT),
    ),
    key=("data_actual_date", "currency_rk"),
    required=("data_actual_date", "currency_rk"),
    interval=("data_actual_date", "data_actual_end_date"),
    max_length={"code_iso_num": 3},
)

MD_LEDGER_ACCOUNT = Table(
    "md_ledger_account_s",
    _struct(
        ("chapter", TEXT),
        ("chapter_name", TEXT),
        ("section_number", INT),
        ("section_name", TEXT),
        ("subsection_name", TEXT),
        ("ledger1_account", INT),
        ("ledger1_account_name", TEXT),
        ("ledger_account", INT),
        ("ledger_account_name", TEXT),
        ("characteristic", TEXT),
        ("is_resident", INT),
        ("is_reserve", INT),
        ("is_reserved", INT),
        ("is_loan", INT),
        ("is_reserved_assets", INT),
        ("is_overdue", INT),
        ("is_interest", INT),
        ("pair_account", TEXT),
        ("start_date", DATE),
        ("end_date", DATE),
        ("is_rub_only", INT),
        ("min_term", TEXT),
        ("min_term_measure", TEXT),
        ("max_term", TEXT),
        ("max_term_measure", TEXT),
        ("ledger_acc_full_name_translit", TEXT),
        ("is_revaluation", TEXT),
        ("is_correct", TEXT),
    ),
    key=("ledger_account", "start_date"),
    required=("ledger_account", "start_date"),
    interval=("start_date", "end_date"),
    max_length={
        "chapter": 1,
        "chapter_name": 16,
        "section_name": 22,
        "subsection_name": 21,
        "ledger1_account_name": 47,
        "ledger_account_name": 153,
        "characteristic": 1,
        "pair_account": 5,
        "min_term": 1,
        "min_term_measure": 1,
        "max_term": 1,
        "max_term_measure": 1,
        "ledger_acc_full_name_translit": 1,
        "is_revaluation": 1,
        "is_correct": 1,
    },
)

# The ledger columns a load supplies; the others keep what the
# table already holds.
LEDGER_LOADED = (
    "chapter",
    "chapter_name",
    "section_number",
    "section_name",
    "subsection_name",
    "ledger1_account",
    "ledger1_account_name",
    "ledger_account",
    "ledger_account_name",
    "characteristic",
    "start_date",
    "end_date",
)

DM_TURNOVER = Table(
    "dm_account_turnover_f",
    _struct(
        ("on_date", DATE),
        ("account_rk", KEY),
        ("credit_amount", MONEY),
        ("credit_amount_rub", MONEY),
        ("debet_amount", MONEY),
        ("debet_amount_rub", MONEY),
    ),
    key=("on_date", "account_rk"),
)

DM_BALANCE = Table(
    "dm_account_balance_f",
    _struct(
        ("on_date", DATE),
        ("account_rk", KEY),
        ("balance_out", MONEY),
        ("balance_out_rub", MONEY),
    ),
    key=("on_date", "account_rk"),
)

DM_FORM101 = Table(
    "dm_f101_round_f",
    _struct(
        ("from_date", DATE),
        ("to_date", DATE),
        ("chapter", TEXT),
        ("ledger_account", TEXT),
        ("characteristic", TEXT),
        *(
            (name, MONEY)
            for measure in FORM101_MEASURES
            for name in (measure, f"r_{measure}")
        ),
    ),
    key=("from_date", "to_date", "chapter", "ledger_account", "characteristic"),
    max_length={"chapter": 1, "ledger_account": 5, "characteristic": 1},
)

PRODUCT = Table(
    "product",
    _struct(
        ("product_rk", KEY),
        ("product_name", TEXT),
        ("effective_from_date", DATE),
        ("effective_to_date", DATE),
    ),
)


def deal_table(deal_sum: T.DataType = T.DecimalType(23, 2)) -> Table:
    """Deals. ``deal_sum`` keeps kopecks by default; pass ``decimal(10,0)`` for
    whole rubles as older loads stored them."""
    return Table(
        "deal_info",
        _struct(
            ("deal_rk", KEY),
            ("deal_num", TEXT),
            ("deal_name", TEXT),
            ("deal_sum", deal_sum),
            ("client_rk", KEY),
            ("account_rk", KEY),
            ("agreement_rk", KEY),
            ("deal_start_date", DATE),
            ("department_rk", KEY),
            ("product_rk", KEY),
            ("deal_type_cd", TEXT),
            ("effective_from_date", DATE),
            ("effective_to_date", DATE),
        ),
    )


DEAL = deal_table()

LOAN_HOLIDAY = Table(
    "loan_holiday",
    _struct(
        ("deal_rk", KEY),
        ("loan_holiday_type_cd", TEXT),
        ("loan_holiday_start_date", DATE),
        ("loan_holiday_finish_date", DATE),
        ("loan_holiday_fact_finish_date", DATE),
        ("loan_holiday_finish_flg", TEXT),
        ("loan_holiday_last_possible_date", DATE),
        ("effective_from_date", DATE),
        ("effective_to_date", DATE),
    ),
)

# The columns of the loan-holiday mart, in order.
LOAN_HOLIDAY_MART_COLUMNS = (
    "deal_rk",
    "effective_from_date",
    "effective_to_date",
    "agreement_rk",
    "account_rk",
    "client_rk",
    "department_rk",
    "product_rk",
    "product_name",
    "deal_type_cd",
    "deal_start_date",
    "deal_name",
    "deal_number",
    "deal_sum",
    "loan_holiday_type_cd",
    "loan_holiday_start_date",
    "loan_holiday_finish_date",
    "loan_holiday_fact_finish_date",
    "loan_holiday_finish_flg",
    "loan_holiday_last_possible_date",
)

ACCOUNT_BALANCE = Table(
    "account_balance",
    _struct(
        ("account_rk", KEY),
        ("effective_date", DATE),
        ("account_in_sum", MONEY),
        ("account_out_sum", MONEY),
    ),
    key=("account_rk", "effective_date"),
    required=("account_rk", "effective_date"),
)
