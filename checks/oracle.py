"""The queries' results in SQL, written from the definitions of the results.

Balances are built day by day with a recursive query, as the plain reading of
"yesterday's balance plus today's turnover" says; turnover multiplies each posting
leg by its rate before adding up.
"""

from __future__ import annotations

FIRST, LAST, DAY_BEFORE = "DATE '1995-01-01'", "DATE '2001-08-31'", "DATE '1994-12-31'"

TABLES = {
    "accounts": """
        SELECT v.data_actual_date, v.data_actual_end_date, c_custkey AS account_rk,
               CAST(30101 + c_custkey % 27 AS VARCHAR)
                   || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS account_number,
               CASE (c_custkey + v.shift) % 3 WHEN 0 THEN 'А' WHEN 1 THEN 'П' ELSE 'A' END
                   AS char_type,
               CAST(c_nationkey AS BIGINT) AS currency_rk,
               CASE c_nationkey WHEN 0 THEN '643' WHEN 1 THEN '810'
                   ELSE CAST(100 + c_nationkey AS VARCHAR) END AS currency_code
        FROM customer
        JOIN (VALUES
            ('gap', DATE '1990-01-01', DATE '1996-03-10', 0),
            ('gap', DATE '1996-03-21', DATE '2050-12-31', 0),
            ('late', DATE '1995-01-15', DATE '2050-12-31', 0),
            ('turned', DATE '1990-01-01', DATE '1997-06-14', 0),
            ('turned', DATE '1997-06-15', DATE '2050-12-31', 1),
            ('plain', DATE '1990-01-01', DATE '2050-12-31', 0)
        ) v(kind, data_actual_date, data_actual_end_date, shift)
          ON v.kind = CASE WHEN c_custkey % 5 = 0 THEN 'gap' WHEN c_custkey % 7 = 1 THEN 'late'
                           WHEN c_custkey % 11 = 2 THEN 'turned' ELSE 'plain' END""",
    "rates": """
        SELECT DATE '1990-01-01' AS data_actual_date, DATE '1998-02-14' AS data_actual_end_date,
               CAST(n_nationkey + 3 AS BIGINT) AS currency_rk,
               CAST(1.5 + n_nationkey * 0.73125001 AS DECIMAL(14,8)) AS reduced_cource,
               CAST(103 + n_nationkey AS VARCHAR) AS code_iso_num
        FROM nation
        UNION ALL
        SELECT DATE '1998-02-15', DATE '2050-12-31', CAST(n_nationkey + 3 AS BIGINT),
               CAST(0.25 + n_nationkey * 1.00000003 AS DECIMAL(14,8)),
               CAST(103 + n_nationkey AS VARCHAR)
        FROM nation""",
    "ledger": """
        SELECT CASE WHEN n_regionkey < 3 THEN 'А' ELSE 'Б' END AS chapter,
               CAST(30101 + n_nationkey AS INTEGER) AS ledger_account,
               DATE '1990-01-01' AS start_date,
               CASE WHEN n_nationkey = 17 THEN DATE '1997-09-15' ELSE DATE '2050-12-31' END
                   AS end_date
        FROM nation""",
    "postings": """
        SELECT CAST(o_orderdate AS DATE) AS oper_date,
               o_custkey AS credit_account_rk, o_custkey + 1 AS debet_account_rk,
               CAST(CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS DECIMAL(23,8))
                   AS credit_amount,
               CAST(CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) * 0.75 AS DECIMAL(23,8))
                   AS debet_amount
        FROM orders""",
    "snapshot": f"""
        SELECT {DAY_BEFORE} AS on_date, c_custkey AS account_rk,
               CAST(c_nationkey + c_custkey % 2 AS BIGINT) AS currency_rk,
               CAST(CAST(round(c_acctbal, 2) AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS balance_out
        FROM customer
        UNION ALL
        SELECT {DAY_BEFORE}, s_suppkey + 9000000000, CAST(s_nationkey AS BIGINT),
               CAST(CAST(round(s_acctbal, 2) AS DECIMAL(18,2)) AS DECIMAL(23,8))
        FROM supplier""",
    "deals": """
        SELECT o_orderkey AS deal_rk, '№ ' || CAST(o_orderkey AS VARCHAR) AS deal_num,
               'Продукт ' || CAST(o_custkey + CASE WHEN o_orderpriority = '1-URGENT'
                                              THEN 1 ELSE 0 END AS VARCHAR) AS deal_name,
               CAST(CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS DECIMAL(23,2)) AS deal_sum,
               o_custkey AS client_rk, o_custkey AS account_rk, o_orderkey + 1 AS agreement_rk,
               CAST(o_orderdate AS DATE) AS deal_start_date, o_custkey % 10 AS department_rk,
               o_custkey AS product_rk, o_orderstatus AS deal_type_cd,
               CAST(date_trunc('year', o_orderdate) AS DATE) AS effective_from_date,
               DATE '2050-12-31' AS effective_to_date
        FROM orders""",
    "holidays": """
        SELECT l_orderkey AS deal_rk, l_returnflag || l_linestatus AS loan_holiday_type_cd,
               CAST(l_shipdate AS DATE) AS loan_holiday_start_date,
               CAST(l_shipdate AS DATE) + l_linenumber * 30 AS loan_holiday_finish_date,
               CASE WHEN l_linenumber > 1 THEN CAST(l_shipdate AS DATE) + l_linenumber END
                   AS loan_holiday_fact_finish_date,
               CASE WHEN l_quantity > 25 THEN 'Y' ELSE 'N' END AS loan_holiday_finish_flg,
               CAST(l_shipdate AS DATE) + 365 AS loan_holiday_last_possible_date,
               CAST(date_trunc('year', l_shipdate) AS DATE) AS effective_from_date,
               CAST(l_shipdate AS DATE) + 1000 AS effective_to_date
        FROM lineitem""",
    "products": """
        SELECT p_partkey AS product_rk, 'Продукт ' || CAST(p_partkey AS VARCHAR) AS product_name,
               make_date(y.year, 1, 1) AS effective_from_date, e.effective_to_date
        FROM part
        CROSS JOIN (SELECT CAST(range AS INTEGER) AS year FROM range(1995, 2001)) y
        JOIN (VALUES (1, DATE '2050-12-31'), (1, DATE '2049-12-31'), (2, DATE '2050-12-31'),
                     (2, DATE '2050-12-31'), (3, DATE '2050-12-31')) e(size, effective_to_date)
          ON e.size = least(p_size, 3)""",
    "account_balance": """
        SELECT account_rk, effective_date,
               CAST(coalesce(lag(account_out_sum) OVER (PARTITION BY account_rk
                                                        ORDER BY effective_date), 0)
                    + CASE WHEN account_rk % 4 = 0 THEN 1 ELSE 0 END AS DECIMAL(23,8))
                   AS account_in_sum,
               account_out_sum
        FROM (SELECT user_id AS account_rk, CAST(ts AS DATE) AS effective_date,
                     CAST(sum(CAST(round(value, 2) AS DECIMAL(18,2))) AS DECIMAL(23,8))
                         AS account_out_sum
              FROM events GROUP BY ALL)""",
    "bank_accounts": """
        SELECT c_custkey AS account_rk, CAST(c_nationkey AS BIGINT) AS department_rk,
               CAST(100 + c_nationkey AS VARCHAR) AS currency_cd
        FROM customer""",
    "currency_names": """
        SELECT CAST(103 + n_nationkey AS VARCHAR) AS currency_cd, n_name AS currency_name
        FROM nation""",
    "clients": """
        SELECT o_custkey AS client_rk,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS effective_from_date,
               nullif(o_orderstatus, 'P') AS status
        FROM orders""",
    "legs": """
        SELECT oper_date AS on_date, credit_account_rk AS account_rk, credit_amount,
               CAST(NULL AS DECIMAL(23,8)) AS debet_amount, 'C' AS side FROM postings
        UNION ALL
        SELECT oper_date, debet_account_rk, CAST(NULL AS DECIMAL(23,8)), debet_amount, 'D' FROM postings""",
    "turnover": """
        SELECT l.on_date, l.account_rk,
               CAST(sum(l.credit_amount) AS DECIMAL(23,8)) AS credit_amount,
               CAST(sum(l.credit_amount * coalesce(r.reduced_cource, 1)) AS DECIMAL(23,8))
                   AS credit_amount_rub,
               CAST(sum(l.debet_amount) AS DECIMAL(23,8)) AS debet_amount,
               CAST(sum(l.debet_amount * coalesce(r.reduced_cource, 1)) AS DECIMAL(23,8))
                   AS debet_amount_rub
        FROM legs l
        JOIN accounts a ON a.account_rk = l.account_rk
             AND l.on_date BETWEEN a.data_actual_date AND a.data_actual_end_date
        LEFT JOIN rates r ON r.currency_rk = a.currency_rk
             AND l.on_date BETWEEN r.data_actual_date AND r.data_actual_end_date
        GROUP BY l.on_date, l.account_rk""",
    "dropped": """
        SELECT l.on_date, count(*) FILTER (side = 'C') AS credit_legs,
               count(*) FILTER (side = 'D') AS debet_legs,
               CAST(sum(credit_amount) AS DECIMAL(23,8)) AS credit_amount,
               CAST(sum(debet_amount) AS DECIMAL(23,8)) AS debet_amount
        FROM legs l
        WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_rk = l.account_rk
                          AND l.on_date BETWEEN a.data_actual_date AND a.data_actual_end_date)
        GROUP BY l.on_date""",
    "opening": f"""
        SELECT s.on_date, a.account_rk, s.balance_out,
               CAST(s.balance_out * coalesce(r.reduced_cource, 1) AS DECIMAL(23,8))
                   AS balance_out_rub
        FROM snapshot s
        JOIN accounts a ON a.account_rk = s.account_rk
             AND {FIRST} BETWEEN a.data_actual_date AND a.data_actual_end_date
        LEFT JOIN rates r ON r.currency_rk = s.currency_rk
             AND {DAY_BEFORE} BETWEEN r.data_actual_date AND r.data_actual_end_date
        WHERE s.on_date = {DAY_BEFORE}""",
    # One step per day: the accounts valid on it, with yesterday's balance if there
    # is one. The day before, and accounts not valid on a day, leave no row to carry.
    "carried": f"""
        SELECT on_date, account_rk, balance_out, balance_out_rub FROM opening
        UNION ALL
        SELECT d.on_date, a.account_rk,
               CAST(coalesce(b.balance_out, 0)
                    + CASE a.char_type WHEN 'А' THEN 1 WHEN 'П' THEN -1 ELSE 0 END
                      * (coalesce(t.debet_amount, 0) - coalesce(t.credit_amount, 0))
                    AS DECIMAL(23,8)),
               CAST(coalesce(b.balance_out_rub, 0)
                    + CASE a.char_type WHEN 'А' THEN 1 WHEN 'П' THEN -1 ELSE 0 END
                      * (coalesce(t.debet_amount_rub, 0) - coalesce(t.credit_amount_rub, 0))
                    AS DECIMAL(23,8))
        FROM (SELECT max(on_date) + 1 AS on_date FROM carried HAVING max(on_date) < {LAST}) d
        JOIN accounts a ON d.on_date BETWEEN a.data_actual_date AND a.data_actual_end_date
        LEFT JOIN carried b ON b.account_rk = a.account_rk
        LEFT JOIN turnover t ON t.account_rk = a.account_rk AND t.on_date = d.on_date""",
    "balances": f"SELECT * FROM carried WHERE on_date >= {FIRST}",
    "months": f"""
        SELECT CAST(range AS DATE) AS from_date, last_day(range) AS to_date
        FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-09-01', INTERVAL 1 MONTH)""",
    "report": """
        SELECT m.from_date, m.to_date, q.chapter,
               CAST(q.ledger_account AS VARCHAR) AS ledger_account,
               a.char_type AS characteristic, a.currency_code IN ('810', '643') AS rub,
               i.balance_in, i.balance_out, t.turn_deb, t.turn_cre
        FROM months m
        JOIN accounts a
          ON a.data_actual_date <= m.from_date AND a.data_actual_end_date >= m.to_date
        JOIN ledger q ON q.start_date <= m.from_date AND q.end_date >= m.to_date
         AND q.ledger_account = CAST(substring(a.account_number, 1, 5) AS INTEGER)
        LEFT JOIN (
            SELECT m.from_date, c.account_rk,
                   coalesce(sum(c.balance_out_rub) FILTER (c.on_date < m.from_date), 0)
                       AS balance_in,
                   coalesce(sum(c.balance_out_rub) FILTER (c.on_date = m.to_date), 0)
                       AS balance_out
            FROM months m JOIN carried c ON c.on_date IN (m.from_date - 1, m.to_date)
            GROUP BY ALL) i
          ON i.account_rk = a.account_rk AND i.from_date = m.from_date
        LEFT JOIN (
            SELECT m.from_date, t.account_rk, sum(t.debet_amount_rub) AS turn_deb,
                   sum(t.credit_amount_rub) AS turn_cre
            FROM months m JOIN turnover t ON t.on_date BETWEEN m.from_date AND m.to_date
            GROUP BY ALL) t
          ON t.account_rk = a.account_rk AND t.from_date = m.from_date""",
    "form": """
        SELECT from_date, to_date, chapter, ledger_account, characteristic, """
    + ", ".join(
        f"CAST(sum({value}) AS DECIMAL(23,8)) AS {name}_{part}"
        for name, amount in (
            ("balance_in", "balance_in"),
            ("turn_deb", "coalesce(turn_deb, 0)"),
            ("turn_cre", "coalesce(turn_cre, 0)"),
            ("balance_out", "balance_out"),
        )
        for part, value in (
            ("rub", f"CASE WHEN rub THEN {amount} ELSE 0 END"),
            ("val", f"CASE WHEN NOT rub THEN {amount} ELSE 0 END"),
            ("total", amount),
        )
    )
    + """
        FROM report GROUP BY from_date, to_date, chapter, ledger_account, characteristic""",
    "loan_mart": """
        SELECT d.* EXCLUDE (deal_num, effective_from_date, effective_to_date),
               d.deal_num AS deal_number, h.* EXCLUDE (deal_rk), p.product_name
        FROM deals d
        LEFT JOIN holidays h
          ON (h.deal_rk, h.effective_from_date) = (d.deal_rk, d.effective_from_date)
        LEFT JOIN (SELECT DISTINCT * FROM products) p
          ON (p.product_rk, p.product_name, p.effective_from_date)
             = (d.product_rk, d.deal_name, d.effective_from_date)""",
    "corrected_in": """
        SELECT b.*, if(p.account_out_sum <> b.account_in_sum, p.account_out_sum,
                       b.account_in_sum) AS correct_account_in_sum
        FROM account_balance b
        ASOF LEFT JOIN account_balance p
          ON p.account_rk = b.account_rk AND p.effective_date < b.effective_date""",
    "audit": """
        SELECT 'turnover' AS step, on_date, count(*) AS row_count,
               CAST(sum(credit_amount_rub) AS DECIMAL(38,8)) AS amount
        FROM turnover GROUP BY on_date
        UNION ALL
        SELECT 'dropped legs', on_date, 1, CAST(debet_amount AS DECIMAL(38,8)) FROM dropped
        UNION ALL
        SELECT 'opening', on_date, count(*), CAST(sum(balance_out_rub) AS DECIMAL(38,8))
        FROM opening GROUP BY on_date
        UNION ALL
        SELECT 'month ends', on_date, count(*), CAST(sum(balance_out_rub) AS DECIMAL(38,8))
        FROM balances WHERE on_date = last_day(on_date) GROUP BY on_date""",
}

# What each derived table reads, in the order they must be defined.
_READS = {
    "legs": ["postings"],
    "turnover": ["legs", "accounts", "rates"],
    "dropped": ["legs", "accounts"],
    "opening": ["snapshot", "accounts", "rates"],
    "carried": ["opening", "accounts", "turnover"],
    "balances": ["carried"],
    "report": ["months", "accounts", "ledger", "carried", "turnover"],
    "form": ["report"],
    "loan_mart": ["deals", "holidays", "products"],
    "corrected_in": ["account_balance"],
    "audit": ["turnover", "dropped", "opening", "balances"],
}


def _with(names: list[str], query: str) -> str:
    """``query`` after the definitions of the named tables and all they read."""
    needed: list[str] = []

    def need(name: str) -> None:
        for read in _READS.get(name, []):
            need(read)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    word = "WITH RECURSIVE" if "carried" in needed else "WITH"
    parts = [
        f"{name} AS {'' if name == 'carried' else 'MATERIALIZED '}({TABLES[name]})"
        for name in needed
    ]
    return f"{word} {', '.join(parts)} {query}"


def _all(name: str) -> str:
    return _with([name], f"SELECT * FROM {name}")


_MONEY_2 = "CAST(round({0}, 2) AS DECIMAL(18,2))"

_MEASURES = [
    f"{name}_{part}"
    for name in ("balance_in", "turn_deb", "turn_cre", "balance_out")
    for part in ("rub", "val", "total")
]


def _form_table(measure: str, empty: str) -> str:
    columns = ["from_date", "to_date", "chapter", "ledger_account", "characteristic"]
    for name in _MEASURES:
        columns += [measure.format(name) + f" AS {name}", f"{empty} AS r_{name}"]
    return _with(["form"], f"SELECT {', '.join(columns)} FROM form")


_NEW_SNAPSHOT = f"""
    SELECT {DAY_BEFORE} AS on_date, o_custkey + 20 AS account_rk,
           CAST(NULL AS BIGINT) AS currency_rk,
           CAST(sum({_MONEY_2.format('o_totalprice')}) AS DECIMAL(23,8)) AS balance_out
    FROM orders GROUP BY o_custkey"""

_DELIVERED = f"""
    SELECT l_partkey + 50 AS p_partkey, 'part ' || CAST(l_partkey + 50 AS VARCHAR) AS p_name,
           CAST(max({_MONEY_2.format('l_extendedprice')}) AS DECIMAL(23,8)) AS price
    FROM lineitem GROUP BY l_partkey"""


def _rule(table: str, name: str, rule: str, columns: str, count: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{columns}' AS columns, "
        f"CAST(({count}) AS BIGINT) AS violations"
    )


def _rules(table, name, required, lengths, key=None, interval=None) -> list[str]:
    parts = [
        _rule(table, name, "not null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL")
        for c in required
    ]
    parts += [
        _rule(table, name, "max length", c, f"SELECT count(*) FROM {table} WHERE length({c}) > {n}")
        for c, n in lengths
    ]
    if key:
        repeated = f"SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1"
        parts.append(
            _rule(table, name, "unique key", key, f"SELECT count(*) FROM ({repeated})")
        )
    if interval:
        entity, start, end = interval
        later = f"""
            SELECT count(DISTINCT (b.{entity}, b.{start})) FROM {table} b
            JOIN {table} a ON a.{entity} = b.{entity} AND a.{start} < b.{start}
             AND a.{end} >= a.{start} AND a.{end} >= b.{start}
            WHERE b.{end} >= b.{start}"""
        parts.append(_rule(table, name, "no overlap", f"{start}, {end}", later))
    return parts


_VERSIONS = """
    SELECT o_custkey AS account_rk, CAST(o_orderdate AS DATE) AS data_actual_date,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) + 100 END
               AS data_actual_end_date,
           nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority
    FROM orders"""

_CONTRACT = (
    _rules(
        "accounts",
        "md_account_d",
        [
            "data_actual_date",
            "data_actual_end_date",
            "account_rk",
            "account_number",
            "char_type",
            "currency_rk",
            "currency_code",
        ],
        [("account_number", 20), ("char_type", 1), ("currency_code", 3)],
        "data_actual_date, account_rk",
        ("account_rk", "data_actual_date", "data_actual_end_date"),
    )
    + _rules(
        "postings",
        "ft_posting_f",
        ["oper_date", "credit_account_rk", "debet_account_rk"],
        [],
    )
    + _rules(
        "lineitem",
        "lineitem",
        ["l_orderkey", "l_linenumber", "l_shipdate"],
        [("l_returnflag", 1), ("l_linestatus", 1)],
        "l_orderkey, l_linenumber",
    )
    + _rules(
        "order_versions",
        "order_versions",
        ["account_rk", "status"],
        [("priority", 5)],
        "account_rk, data_actual_date",
        ("account_rk", "data_actual_date", "data_actual_end_date"),
    )
)

_LOAN_COLUMNS = [
    "deal_rk",
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
]

def _row(name: str, start: str, end: str, key: str, texts: str, amount: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, {start} AS from_date, CAST({end} AS DATE) AS to_date, "
        f"CAST({key} AS BIGINT) AS key, concat_ws('|', {texts}) AS texts, "
        f"CAST({amount} AS DECIMAL(23,8)) AS amount FROM {table}"
    )


_FROM, _TO = "data_actual_date", "data_actual_end_date"
_DETAIL = [
    _row("md_account_d", _FROM, _TO, "account_rk", "account_number, char_type, currency_rk, currency_code", "NULL", "accounts"),
    _row("md_currency_d", _FROM, _TO, "currency_rk", "code_iso_num", "NULL", "rates"),
    _row("md_exchange_rate_d", _FROM, _TO, "currency_rk", "code_iso_num", "reduced_cource", "rates"),
    _row("md_ledger_account_s", "start_date", "end_date", "ledger_account", "chapter", "CASE chapter WHEN 'А' THEN 7 END", "ledger"),
    _row("ft_balance_f", "on_date", "NULL", "account_rk", "currency_rk", "balance_out", "snapshot"),
    _row("ft_balance_f", "on_date - 31", "NULL", "account_rk", "currency_rk", "balance_out", "snapshot"),
    _row("ft_posting_f", "oper_date", "NULL", "credit_account_rk", "debet_account_rk", "debet_amount", "(SELECT DISTINCT * FROM postings)"),
]

ORACLE_SQL: dict[str, str] = {
    "turnover_daily": _all("turnover"),
    "turnover_dropped_legs": _all("dropped"),
    "rate_asof": _with(
        ["rates"],
        """SELECT o_orderkey, o_custkey AS c_custkey, CAST(o_orderdate AS DATE) AS on_date,
                  CAST(CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS amount,
                  CAST(c_nationkey AS BIGINT) AS currency_rk, s.rate
           FROM orders JOIN customer ON c_custkey = o_custkey
           LEFT JOIN (
               SELECT currency_rk, make_date(y.year, 9, 1) AS start, make_date(y.year + 1, 4, 30) AS stop,
                      CAST(reduced_cource + y.year AS DECIMAL(14,8)) AS rate
               FROM rates CROSS JOIN (SELECT CAST(range AS INTEGER) AS year FROM range(1995, 2002)) y
               WHERE data_actual_date < DATE '1998-01-01') s
             ON s.currency_rk = c_nationkey AND CAST(o_orderdate AS DATE) BETWEEN s.start AND s.stop""",
    ),
    "opening_balance": _all("opening"),
    "balance_daily": _with(
        ["balances"],
        """SELECT account_rk, CAST(date_trunc('month', on_date) AS DATE) AS month,
                  count(*) AS days,
                  CAST(sum(balance_out) AS DECIMAL(23,8)) AS balance_out,
                  CAST(sum(balance_out_rub) AS DECIMAL(23,8)) AS balance_out_rub,
                  min(balance_out) AS least, max(balance_out) AS most
           FROM balances GROUP BY ALL""",
    ),
    "balance_month_end": _with(
        ["balances"], "SELECT * FROM balances WHERE on_date = last_day(on_date)"
    ),
    "form101": _all("form"),
    "f101_export": _form_table("CAST({0} AS VARCHAR)", "CAST(NULL AS DECIMAL(23,8))"),
    "f101_csv_roundtrip": _form_table("{0}", "CAST(NULL AS DECIMAL(23,8))"),
    "month_close_stored": _with(
        ["balances"],
        "SELECT * FROM balances WHERE on_date BETWEEN DATE '1995-01-01' AND DATE '1996-04-30'"
        " AND (on_date NOT BETWEEN DATE '1995-04-01' AND DATE '1996-01-31' OR on_date = last_day(on_date))",
    ),
    "close_log": _with(
        ["turnover", "snapshot"],
        """SELECT 'turnover' AS step, on_date, count(*) AS row_count FROM turnover
           WHERE on_date BETWEEN DATE '1996-02-01' AND DATE '1996-02-29' GROUP BY on_date
           UNION ALL
           SELECT 'balances', d.on_date, count(*)
           FROM (SELECT CAST(range AS DATE) AS on_date
                 FROM range(TIMESTAMP '1996-02-01', TIMESTAMP '1996-03-01', INTERVAL 1 DAY)) d
           JOIN accounts a ON d.on_date BETWEEN a.data_actual_date AND a.data_actual_end_date
           GROUP BY d.on_date
           UNION ALL
           SELECT 'balances', DATE '1996-01-31', count(*)
           FROM snapshot s JOIN accounts a ON a.account_rk = s.account_rk
            AND DATE '1996-02-01' BETWEEN a.data_actual_date AND a.data_actual_end_date""",
    ),
    "late_postings": _with(
        ["balances"], "SELECT * FROM balances WHERE on_date = last_day(on_date)"
    ),
    "late_turnover": _all("turnover"),
    "form101_bucketed": _all("form"),
    "detail_by_day": _with(
        ["snapshot", "legs"],
        """SELECT on_date, account_rk,
                  CAST(CASE WHEN balance_out >= 0 THEN balance_out ELSE balance_out + 1 END
                       AS DECIMAL(23,8)) AS balance_out, 'balance' AS kind
           FROM snapshot
           UNION ALL
           SELECT on_date - 1, account_rk, CAST(balance_out + 1 AS DECIMAL(23,8)), 'balance'
           FROM snapshot
           UNION ALL
           SELECT on_date, account_rk, CAST(sum(credit_amount) AS DECIMAL(23,8)), 'credit'
           FROM legs GROUP BY on_date, account_rk""",
    ),
    "typed_load": _with(["postings"], "SELECT DISTINCT * FROM postings"),
    "load_rejects": f"""
        WITH lines AS (
            SELECT CAST(o_orderdate AS DATE) AS day, {_MONEY_2.format('o_totalprice')} AS amount,
                   o_totalprice < 2000 AS bad_day, o_orderstatus = 'P' AS no_debet,
                   o_totalprice > 300000 AS bad_amount, o_orderpriority = '1-URGENT' AS short,
                   CAST(o_custkey AS VARCHAR) AS credit, CAST(o_custkey + 1 AS VARCHAR) AS debet
            FROM orders
        ), judged AS (
            SELECT *, CASE WHEN short THEN 'not as many fields as columns' ELSE concat_ws('; ',
                CASE WHEN bad_day THEN 'oper_date: not a date as dd-MM-yyyy' END,
                CASE WHEN no_debet THEN 'debet_account_rk: missing' END,
                CASE WHEN bad_amount THEN 'credit_amount: not a number' END) END AS rules,
                10 + 3 + length(credit) + CASE WHEN no_debet THEN 0 ELSE length(debet) END
                + length(CAST(amount AS VARCHAR)) + CASE WHEN bad_amount THEN 1 ELSE 0 END
                + CASE WHEN short THEN 0 ELSE 1 + length(CAST(amount AS VARCHAR)) END AS size
            FROM lines
        )
        SELECT 'good ' || CAST(day AS VARCHAR) AS rules, count(*) AS line_count,
               CAST(sum(amount) AS DECIMAL(23,8)) AS amount
        FROM judged WHERE rules = '' GROUP BY day
        UNION ALL
        SELECT rules, count(*), CAST(sum(size) AS DECIMAL(23,8))
        FROM judged WHERE rules <> '' GROUP BY rules""",
    "typed_load_accounts": _all("accounts"),
    "typed_load_rates": _all("rates"),
    "typed_load_balances": _with(["snapshot"], "SELECT DISTINCT * FROM snapshot"),
    "typed_load_code_page": _all("deals"),
    "typed_load_currencies": _with(
        ["rates"],
        """SELECT DISTINCT currency_rk, data_actual_date, data_actual_end_date,
                  code_iso_num AS currency_code, CAST(NULL AS VARCHAR) AS code_iso_char
           FROM rates""",
    ),
    "typed_load_ledger": _with(
        ["ledger"],
        """SELECT DISTINCT chapter, CAST(NULL AS VARCHAR) AS chapter_name,
                  CAST(NULL AS INTEGER) AS section_number, CAST(NULL AS VARCHAR) AS section_name,
                  CAST(NULL AS VARCHAR) AS subsection_name,
                  CAST(NULL AS INTEGER) AS ledger1_account,
                  CAST(NULL AS VARCHAR) AS ledger1_account_name, ledger_account,
                  CAST(NULL AS VARCHAR) AS ledger_account_name,
                  CAST(NULL AS VARCHAR) AS characteristic, start_date, end_date
           FROM ledger""",
    ),
    "detail_load": _with(
        ["accounts", "rates", "ledger", "snapshot", "postings"], " UNION ALL ".join(_DETAIL)
    ),
    "keyed_upsert": _with(
        ["snapshot"],
        f"""SELECT * FROM ({_NEW_SNAPSHOT})
            UNION ALL
            SELECT * FROM snapshot s WHERE NOT EXISTS (
                SELECT 1 FROM ({_NEW_SNAPSHOT}) n
                WHERE n.on_date = s.on_date AND n.account_rk = s.account_rk)""",
    ),
    "keyed_upsert_partial": f"""
        SELECT coalesce(n.p_partkey, p.p_partkey) AS p_partkey,
               coalesce(n.p_name, p.p_name) AS p_name, p.p_brand, p.p_size,
               CAST(coalesce(n.price, {_MONEY_2.format('p.p_retailprice')}) AS DECIMAL(23,8))
                   AS price
        FROM part p FULL JOIN ({_DELIVERED}) n ON n.p_partkey = p.p_partkey""",
    "replace_slice": f"""
        SELECT * FROM (
            SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS on_date,
                   o_orderkey AS number,
                   CAST({_MONEY_2.format('o_totalprice')} AS DECIMAL(23,8)) AS amount
            FROM orders)
        WHERE on_date IS NULL OR on_date NOT BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
        UNION ALL
        SELECT CAST(l_shipdate AS DATE), l_orderkey,
               CAST({_MONEY_2.format('l_extendedprice')} AS DECIMAL(23,8))
        FROM lineitem
        WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    "append_new_rows": _with(
        ["clients"],
        """SELECT * FROM clients WHERE effective_from_date < DATE '1998-01-01'
           UNION ALL
           (SELECT * FROM clients
            EXCEPT SELECT * FROM clients WHERE effective_from_date < DATE '1998-01-01')""",
    ),
    "full_refresh": _with(["products"], "SELECT DISTINCT * FROM products"),
    "dedupe_rows": _with(["clients"], "SELECT DISTINCT * FROM clients"),
    "contract_violations": "WITH order_versions AS (" + _VERSIONS + "), accounts AS ("
    + TABLES["accounts"] + "), postings AS (" + TABLES["postings"] + ") "
    + " UNION ALL ".join(_CONTRACT),
    "duplicate_profile": _with(
        ["clients"],
        """SELECT unnest(['всего записей', 'уникальных записей']) AS title,
                  unnest([count(*), count(DISTINCT (client_rk, effective_from_date, status))])
                      AS count
           FROM clients""",
    ),
    "duplicate_key_rows": """
        SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    "nonnull_profile": _with(
        ["loan_mart"],
        f"""SELECT effective_from_date, effective_to_date,
                   count(effective_from_date) AS effective_from_date_c,
                   count(effective_to_date) AS effective_to_date_c,
                   {', '.join(f'count({c}) AS {c}' for c in _LOAN_COLUMNS)}
            FROM loan_mart GROUP BY effective_from_date, effective_to_date""",
    ),
    "step_audit": _all("audit"),
    "run_log": _with(
        ["audit"],
        """SELECT 'info' AS log_type,
                  step || ' ' || CAST(on_date AS VARCHAR) || ': '
                       || CAST(row_count AS VARCHAR) || ' rows' AS log_message
           FROM audit""",
    ),
    "loan_holiday_mart": _all("loan_mart"),
    "balance_repair_in": _with(
        ["corrected_in"],
        """SELECT account_rk, effective_date, correct_account_in_sum AS account_in_sum,
                  account_out_sum FROM corrected_in""",
    ),
    "balance_corrections_in": _all("corrected_in"),
    "balance_repair_out": _with(
        ["account_balance"],
        """SELECT b.*, if(n.account_in_sum <> b.account_out_sum, n.account_in_sum,
                          b.account_out_sum) AS correct_account_out_sum
           FROM account_balance b
           ASOF LEFT JOIN account_balance n
             ON n.account_rk = b.account_rk AND n.effective_date > b.effective_date""",
    ),
    "balance_repair_preview": _with(
        ["corrected_in"],
        "SELECT * FROM corrected_in ORDER BY account_rk, effective_date LIMIT 40",
    ),
    "account_balance_turnover": _with(
        ["corrected_in", "bank_accounts", "currency_names"],
        """SELECT a.account_rk, coalesce(n.currency_name, '-1') AS currency_name,
                  a.department_rk, b.effective_date,
                  b.correct_account_in_sum AS account_in_sum, b.account_out_sum
           FROM bank_accounts a
           LEFT JOIN corrected_in b ON b.account_rk = a.account_rk
           LEFT JOIN currency_names n ON n.currency_cd = a.currency_cd
           ORDER BY a.account_rk, b.effective_date""",
    ),
    "scalar_functions": f"""
        SELECT o_orderkey AS order_rk, CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority,
               CAST(o_orderdate AS DATE) AS iso_day,
               CAST(o_orderdate - INTERVAL 1 MONTH AS DATE) AS month_before,
               CAST(o_orderdate AS DATE) - 1 AS day_before,
               CAST({_MONEY_2.format('o_totalprice')} AS DECIMAL(23,8)) AS amount,
               CAST(CAST(-{_MONEY_2.format('o_totalprice')} AS DECIMAL(23,8)) AS VARCHAR)
                   AS amount_text
        FROM orders""",
    # The events are of 2024, when Moscow is three hours ahead all year.
    "moscow_times": """
        SELECT event_id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS moscow FROM events""",
}
