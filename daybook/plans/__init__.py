from daybook.plans.balance_repair import repair_and_publish
from daybook.plans.detail_load import (
    load_detail,
    load_dimensions,
    load_facts,
    typed_accounts,
    typed_balances,
    typed_currencies,
    typed_ledger,
    typed_postings,
    typed_rates,
)
from daybook.plans.loan_refresh import refresh_loans
from daybook.plans.month_close import (
    MonthClose,
    apply_late,
    close_month,
    export_form101,
    publish_month,
)

__all__ = [
    "MonthClose",
    "apply_late",
    "close_month",
    "export_form101",
    "load_detail",
    "load_dimensions",
    "load_facts",
    "publish_month",
    "refresh_loans",
    "repair_and_publish",
    "typed_accounts",
    "typed_balances",
    "typed_currencies",
    "typed_ledger",
    "typed_postings",
    "typed_rates",
]
