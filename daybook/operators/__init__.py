from daybook.operators.asof import asof_join
from daybook.operators.balances import balances, opening_balances
from daybook.operators.continuity import (
    account_balance_turnover,
    in_sum_corrections,
    out_sum_corrections,
    preview,
    repair_in_sums,
)
from daybook.operators.form101 import form101, form101_table, form101_text
from daybook.operators.late import late_balances, late_turnover
from daybook.operators.loans import loan_holiday_mart
from daybook.operators.lookup import heavy_keys, left_join_skewed
from daybook.operators.maintain import append_new, dedupe, replace_slice, upsert
from daybook.operators.parts import in_parts, part_count
from daybook.operators.quality import (
    duplicate_key_rows,
    duplicate_profile,
    nonnull_profile,
    run_log,
    step_audit,
    violations,
)
from daybook.operators.turnover import dropped_legs, posting_legs, turnover

__all__ = [
    "account_balance_turnover",
    "append_new",
    "asof_join",
    "balances",
    "dedupe",
    "dropped_legs",
    "duplicate_key_rows",
    "duplicate_profile",
    "form101",
    "form101_table",
    "form101_text",
    "heavy_keys",
    "in_parts",
    "in_sum_corrections",
    "late_balances",
    "late_turnover",
    "left_join_skewed",
    "loan_holiday_mart",
    "nonnull_profile",
    "opening_balances",
    "out_sum_corrections",
    "part_count",
    "posting_legs",
    "preview",
    "repair_in_sums",
    "replace_slice",
    "run_log",
    "step_audit",
    "turnover",
    "upsert",
    "violations",
]
