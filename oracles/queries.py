"""Final statement of every oracle, and their assembly with the CTEs they need."""

from __future__ import annotations

import re

from oracles.mapping import RAW
from oracles.models import AS_OF, MODELS, payroll_legs, pct
from oracles.rules import ACCEPTED, FOREIGN_KEYS, NOT_NULL, RAW_COLUMNS, UNIQUE

CTES = {**RAW, **MODELS}


def statement(body: str) -> str:
    """``body`` preceded by the CTEs it uses, in dependency order."""
    needed: dict[str, None] = {}

    def visit(sql: str, skip: str | None = None) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", sql)):
            if word in CTES and word != skip and word not in needed:
                visit(CTES[word], word)
                needed[word] = None

    visit(body)
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def doubles(source: str, *money: str) -> str:
    """Everything of ``source`` with the money columns as DOUBLE."""
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money)
    return f"SELECT * REPLACE ({casts}) FROM {source}" if money else f"SELECT * FROM {source}"


def whole(expr: str, name: str) -> str:
    return f"CAST(round({expr}, 0) AS DOUBLE) AS {name}"


def total(col: str, name: str | None = None) -> str:
    return whole(f"sum({col})", name or col)


RAW_TABLES = list(RAW_COLUMNS)


def bronze_name(table: str) -> str:
    return "stg_" + table.removeprefix("raw_")


def raw_columns(table: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in RAW_COLUMNS[table].split(", ")]


def staged(table: str) -> str:
    """The declared columns of a raw table with decimals as DOUBLE."""
    cols = [f"CAST({c} AS DOUBLE) AS {c}" if kind.startswith("decimal") else c for c, kind in raw_columns(table)]
    return f"SELECT {', '.join(cols)} FROM {table}"


LEG_MONEY = ("debit_amount", "credit_amount")
LINE_MONEY = (
    "unit_price",
    "gross_amount",
    "invoice_header_total",
    "line_discount_amount",
    "calculated_line_net_amount",
)
MRR_MONEY = ("mrr", "arr", "lifetime_revenue_to_date", "active_mrr_baseline")
PNL_MONEY = (
    "period_amount",
    "signed_period_amount",
    "ytd_cumulative_amount",
    "prior_month_amount",
    "mom_variance_abs",
    "prior_year_same_month_amount",
    "yoy_variance_abs",
    "budget_amount",
    "actuals_vs_budget_abs",
)
BALANCE_MONEY = ("period_movement", "closing_balance", "prior_month_balance", "mom_balance_change")
CASH_MONEY = (
    "total_cash_inflow",
    "total_cash_outflow",
    "net_cash_movement",
    "cumulative_cash_balance",
    "prior_month_net_cash",
    "mom_cash_variance",
)
MODEL_MONEY = {
    "dim_accounts": (),
    "dim_customers": ("credit_limit",),
    "dim_employees": ("salary",),
    "dim_products": ("unit_price",),
    "dim_vendors": (),
    "fact_invoices": LINE_MONEY,
    "fact_journal_entries": (*LEG_MONEY, "net_amount", "standard_balance_amount"),
    "fact_payments": ("amount",),
    "fact_payroll": ("gross_pay", "tax_withheld", "net_pay"),
    "fact_subscriptions": MRR_MONEY,
    "fact_vendor_bills": ("amount",),
    "rpt_pl_statement": PNL_MONEY,
    "rpt_balance_sheet": BALANCE_MONEY,
    "rpt_cash_flow": CASH_MONEY,
    "rpt_mrr": MRR_MONEY,
    "rpt_revenue_summary": ("gross_revenue", "total_discounts", "net_revenue"),
    "rpt_ar_aging": ("credit_limit", "gross_amount", "invoice_header_total", "net_amount", "discount_amount"),
    "rpt_opex_by_vendor": ("amount", "total_spend_this_month_per_vendor", "total_spend_this_month_per_account"),
    "rpt_payroll_burn": (
        "gross_pay",
        "tax_withheld",
        "net_pay",
        "dept_gross_pay_this_month",
        "total_payroll_this_month",
    ),
}

N = "CAST(count(*) AS BIGINT)"
FIRST, LAST = 1995, 2001
SERVING = {
    "kpis": f"""SELECT {whole("sum(CASE WHEN is_active THEN mrr ELSE 0 END)", "current_mrr")},
  {whole("sum(CASE WHEN is_active THEN arr ELSE 0 END)", "current_arr")},
  count(CASE WHEN is_active THEN 1 END) AS active_subs, count(CASE WHEN is_churned THEN 1 END) AS churned_subs,
  {pct("count(CASE WHEN is_churned THEN 1 END)", "count(*)", 1)} AS churn_rate_pct,
  round(CAST(sum(CASE WHEN is_active THEN mrr ELSE 0 END) AS DOUBLE) / nullif(count(CASE WHEN is_active THEN 1 END), 0), 0) AS avg_mrr_per_sub
FROM rpt_mrr""",
    "kpis_gross_margin": f"""SELECT entry_year, {whole("revenue", "total_revenue")}, {whole("cogs", "total_cogs")},
  {pct("(revenue - cogs)", "revenue", 1)} AS gross_margin_pct
FROM (SELECT entry_year, sum(CASE WHEN account_type = 'REVENUE' THEN signed_period_amount ELSE 0 END) AS revenue,
    sum(CASE WHEN account_type = 'COGS' THEN abs(signed_period_amount) ELSE 0 END) AS cogs
  FROM rpt_pl_statement WHERE entry_year = (SELECT max(entry_year) FROM rpt_pl_statement) GROUP BY entry_year) y""",
    "kpis_cash_balance": """SELECT coalesce((SELECT CAST(closing_balance AS DOUBLE) FROM rpt_balance_sheet
  WHERE account_name = 'CASH AND CASH EQUIVALENTS' ORDER BY entry_month DESC NULLS FIRST LIMIT 1), 0) AS cash_balance""",
    "pnl": f"SELECT entry_month, entry_year, account_type, {total('signed_period_amount', 'amount')} FROM rpt_pl_statement GROUP BY ALL",
    "pnl_detail": f"""SELECT entry_month, entry_year, account_type, account_subtype, account_name, {whole("period_amount", "period_amount")},
  {whole("signed_period_amount", "signed_period_amount")}, {whole("ytd_cumulative_amount", "ytd_amount")}, mom_variance_pct, yoy_variance_pct,
  CAST(round(CAST(pct_of_revenue AS DECIMAL(18,2)), 1) AS DOUBLE) AS pct_of_revenue FROM rpt_pl_statement""",
    "mrr_trend": f"""SELECT invoice_month, invoice_year, {total("gross_revenue", "sub_revenue")}, count(DISTINCT customer_id) AS paying_customers
FROM rpt_revenue_summary WHERE invoice_type = 'SUBSCRIPTION' GROUP BY ALL""",
    "mrr_by_plan": f"SELECT plan_name, {N} AS sub_count, {total('mrr', 'total_mrr')}, {total('arr', 'total_arr')} FROM rpt_mrr WHERE is_active GROUP BY ALL",
    "mrr_lifecycle": f"SELECT account_lifecycle_stage, {N} AS sub_count, {total('mrr', 'total_mrr')} FROM rpt_mrr WHERE is_active GROUP BY ALL",
    "revenue_by_segment": f"""SELECT segment, invoice_type, {total("gross_revenue")}, {total("net_revenue")},
  count(DISTINCT customer_id) AS customer_count FROM rpt_revenue_summary GROUP BY ALL""",
    "revenue_by_rep": f"""SELECT sales_rep_name, {total("gross_revenue")}, {total("net_revenue")}, count(DISTINCT customer_id) AS customers,
  CAST(sum(invoice_count) AS BIGINT) AS invoices FROM rpt_revenue_summary GROUP BY ALL
ORDER BY gross_revenue DESC NULLS FIRST, sales_rep_name ASC NULLS LAST LIMIT 15""",
    "revenue_monthly": f"SELECT invoice_month, invoice_type, {total('gross_revenue')} FROM rpt_revenue_summary GROUP BY ALL",
    "ar_aging": f"""SELECT ar_aging_bucket, {N} AS invoice_count, {total("gross_amount", "total_exposure")},
  round(avg(days_past_due), 0) AS avg_days_past_due FROM rpt_ar_aging WHERE NOT is_paid_invoice GROUP BY ALL""",
    "ar_aging_by_segment": f"""SELECT segment, ar_aging_bucket, {N} AS invoice_count, {total("gross_amount", "total_exposure")}
FROM rpt_ar_aging WHERE NOT is_paid_invoice GROUP BY ALL""",
    "balance_sheet": f"SELECT entry_month, entry_year, account_type, bs_section, {total('closing_balance')} FROM rpt_balance_sheet GROUP BY ALL",
    "balance_sheet_latest": f"""SELECT account_type, account_subtype, account_name, bs_section, {whole("closing_balance", "closing_balance")}
FROM rpt_balance_sheet WHERE entry_month = (SELECT max(entry_month) FROM rpt_balance_sheet)""",
    "cash_flow": f"""SELECT entry_month, entry_year, cash_flow_category, category_sort_key, {whole("total_cash_inflow", "total_inflow")},
  {whole("total_cash_outflow", "total_outflow")}, {whole("net_cash_movement", "net_movement")},
  {whole("cumulative_cash_balance", "cumulative_balance")} FROM rpt_cash_flow""",
    "cash_flow_summary": f"SELECT entry_year, cash_flow_category, {total('net_cash_movement', 'net_movement')} FROM rpt_cash_flow GROUP BY ALL",
    "opex_vendor": f"""SELECT vendor_name, vendor_category, expense_account_name, {total("amount", "total_spend")}, {N} AS bill_count,
  round(CAST(sum(amount) AS DOUBLE) / count(amount), 0) AS avg_monthly_spend FROM rpt_opex_by_vendor GROUP BY ALL
ORDER BY total_spend DESC NULLS FIRST, vendor_name, vendor_category, expense_account_name LIMIT 15""",
    "opex_vendor_monthly": f"SELECT bill_month, bill_year, vendor_category, {total('amount', 'total_spend')} FROM rpt_opex_by_vendor GROUP BY ALL",
    "payroll": f"""SELECT pay_month, pay_year, department, pay_type, {total("gross_pay")}, {total("tax_withheld")}, {total("net_pay")},
  count(DISTINCT employee_id) AS headcount FROM rpt_payroll_burn GROUP BY ALL""",
    "payroll_annual": f"""SELECT pay_year, department, pay_type, {total("gross_pay")}, count(DISTINCT employee_id) AS headcount
FROM rpt_payroll_burn GROUP BY ALL""",
}

SERVING |= {f"{n}_bitmaps": SERVING[n] for n in ("mrr_trend", "revenue_by_segment", "revenue_by_rep", "payroll", "payroll_annual")}

UNBALANCED = """SELECT transaction_ref, CAST(sum(debit_amount) - sum(credit_amount) AS DOUBLE) AS imbalance
FROM {source} GROUP BY transaction_ref HAVING abs(sum(debit_amount) - sum(credit_amount)) > 0.01"""

SCHEDULE = """SELECT s.*, CAST(unnest(generate_series(CAST(date_trunc('month', greatest(start_date, DATE '1995-01-01')) AS TIMESTAMP),
    CAST(least(coalesce(end_date, DATE '2001-08-31'), DATE '2001-08-31') AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS d
  FROM raw_subscriptions s"""
# Decimal arithmetic throughout: DuckDB divides decimals as doubles, so twelfths are
# taken of whole cents, and the raise compounds by multiplication.
PAY_SCHEDULE = """SELECT *, CAST((CAST(annual * 100 AS BIGINT) * 2 + 12) // 24 AS DECIMAL(15,0)) * CAST(0.01 AS DECIMAL(3,2)) AS gross_pay FROM (
  SELECT e.*, CAST(round(salary * (CASE WHEN k >= 1 THEN f ELSE 1 END) * (CASE WHEN k >= 2 THEN f ELSE 1 END)
      * (CASE WHEN k >= 3 THEN f ELSE 1 END), 2) AS DECIMAL(15,2)) AS annual FROM (
    SELECT *, year(m) - 1995 AS k FROM (
      SELECT *, 1 + CAST(3 + CAST(substr(employee_id, 2) AS BIGINT) % 3 AS DECIMAL(2,0)) * CAST(0.01 AS DECIMAL(3,2)) AS f,
        CAST((22 + CAST(substr(employee_id, 2) AS BIGINT) % 11) AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS t,
        CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH)) AS DATE) AS m
      FROM raw_employees) n) e) p"""
_TAX = "CAST(round(gross_pay * t, 2) AS DECIMAL(15,2))"


DERIVED = {
    "post_payroll_gl_by_dept": doubles(
        "("
        + payroll_legs(
            "CASE department WHEN 'Engineering' THEN '6000' WHEN 'Sales' THEN '6010' WHEN 'Customer Success' THEN '6020' ELSE '6030' END"
        )
        + ") x",
        *LEG_MONEY,
    ),
    "build_journal": doubles("raw_journal_entries", *LEG_MONEY),
    "gl_unbalanced_refs": UNBALANCED.format(
        source="(SELECT * REPLACE (debit_amount + CASE WHEN transaction_type = 'INVOICE' AND entry_id LIKE '%-1' THEN "
        "CASE WHEN TRY_CAST(substr(transaction_ref, 2) AS BIGINT) % 89 = 0 THEN 1.00 "
        "WHEN TRY_CAST(substr(transaction_ref, 2) AS BIGINT) % 97 = 0 THEN 0.01 ELSE 0 END ELSE 0 END AS debit_amount) FROM raw_journal_entries) j"
    ),
    "billing_schedule": f"""SELECT subscription_id || '-' || strftime(d, '%Y%m') AS invoice_id, customer_id, subscription_id, product_id,
  'Subscription' AS invoice_type, d AS invoice_date, d + 30 AS due_date, CAST(mrr AS DOUBLE) AS total_amount,
  plan_name || ' -- ' || strftime(d, '%B %Y') AS description, strftime(d, '%B %Y') AS label, d AS created_at FROM ({SCHEDULE}) x""",
    "select_paid_for_payment": staged("raw_invoices") + " WHERE lower(trim(status)) = 'paid'",
    "invoice_lines_from_schedule": f"""SELECT subscription_id || '-' || strftime(d, '%Y%m') || '-1' AS line_id,
  subscription_id || '-' || strftime(d, '%Y%m') AS invoice_id, product_id, plan_name || ' -- ' || strftime(d, '%B %Y') AS description,
  1 AS quantity, CAST(mrr AS DOUBLE) AS unit_price, CAST(0 AS DOUBLE) AS discount_pct, CAST(mrr AS DOUBLE) AS line_total FROM ({SCHEDULE}) x""",
    "one_off_invoices": """SELECT 'M' || k AS invoice_id, customer_id, CAST(NULL AS VARCHAR) AS subscription_id,
  'Professional Services' AS invoice_type, d AS invoice_date, d + 30 AS due_date, CAST(quantity * unit_price AS DOUBLE) AS total_amount,
  'M' || k || '-1' AS line_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(0 AS DOUBLE) AS discount_pct,
  CAST(quantity * unit_price AS DOUBLE) AS line_total
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k, 'C' || o_custkey AS customer_id, 'P' || (o_orderkey % 100) AS pid,
    CAST(1 + o_orderkey % 2 AS INT) AS quantity, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT') o
JOIN raw_products ON product_id = pid""",
    "close_out_subscriptions": """SELECT subscription_id, customer_id, product_id, plan_name,
  CASE WHEN churn IS NULL THEN 'Active' ELSE 'Churned' END AS status, CAST(mrr AS DOUBLE) AS mrr, start_date, churn AS end_date,
  created_at, coalesce(churn, DATE '2001-08-31') AS updated_at
FROM (SELECT *, CASE WHEN lower(trim(status)) = 'churned' THEN end_date END AS churn FROM raw_subscriptions) s""",
    "payroll_schedule": f"""SELECT employee_id || '-' || strftime(m, '%Y%m') || '-SALARY' AS payroll_id, employee_id, department,
  m AS pay_period_start, last_day(m) AS pay_period_end, CAST(gross_pay AS DOUBLE) AS gross_pay, CAST({_TAX} AS DOUBLE) AS tax_withheld,
  CAST(gross_pay - {_TAX} AS DOUBLE) AS net_pay, last_day(m) + 2 AS payment_date, 'Salary' AS pay_type, last_day(m) AS created_at
FROM ({PAY_SCHEDULE}) x""",
    "december_bonus": f"""SELECT employee_id || '-' || strftime(m, '%Y%m') || '-BONUS' AS payroll_id, employee_id, department,
  m AS pay_period_start, last_day(m) AS pay_period_end, CAST(b AS DOUBLE) AS gross_pay,
  CAST(round(b * CAST(0.37 AS DECIMAL(3,2)), 2) AS DOUBLE) AS tax_withheld, CAST(round(b * CAST(0.63 AS DECIMAL(3,2)), 2) AS DOUBLE) AS net_pay,
  last_day(m) AS payment_date, 'Bonus' AS pay_type, last_day(m) AS created_at
FROM (SELECT *, CAST(round(gross_pay * CAST(0.25 AS DECIMAL(3,2)), 2) AS DECIMAL(15,2)) AS b FROM ({PAY_SCHEDULE}) x WHERE month(m) = 12) y""",
    "account_code_lookup": """SELECT bill_id, expense_account_id, a.account_code FROM raw_vendor_bills b
LEFT JOIN raw_chart_of_accounts a ON a.account_id = b.expense_account_id""",
    "revenue_by_year_type": """SELECT CAST(year(invoice_date) AS INT) AS year,
  CAST(sum(CASE WHEN kind = 'Subscription' THEN total_amount ELSE 0 END) AS DOUBLE) AS "Subscription",
  CAST(sum(CASE WHEN kind = 'Professional Services' THEN total_amount ELSE 0 END) AS DOUBLE) AS "Professional Services",
  CAST(sum(CASE WHEN kind = 'Setup `one.off`' THEN total_amount ELSE 0 END) AS DOUBLE) AS "Setup `one.off`",
  CAST(sum(CASE WHEN kind = 'year' THEN total_amount ELSE 0 END) AS DOUBLE) AS year_2,
  CAST(sum(CASE WHEN kind IS NULL THEN total_amount ELSE 0 END) AS DOUBLE) AS "null"
FROM (SELECT *, CASE WHEN n % 17 = 0 AND n % 11 > 0 AND n % 13 > 0 THEN NULL WHEN n % 11 = 0 THEN 'Setup `one.off`' WHEN n % 13 = 0 THEN 'year'
    ELSE invoice_type END AS kind FROM (SELECT *, CAST(substr(invoice_id, 2) AS BIGINT) AS n FROM raw_invoices) r) i
GROUP BY 1""",
    "payroll_by_year": "SELECT CAST(year(pay_period_start) AS INT) AS year, CAST(sum(gross_pay) AS DOUBLE) AS gross_pay FROM raw_payroll GROUP BY 1",
    "vendor_spend_by_year": "SELECT CAST(year(bill_date) AS INT) AS year, CAST(sum(amount) AS DOUBLE) AS vendor_spend FROM raw_vendor_bills GROUP BY 1",
    "active_subs_at_year_end": f"""SELECT y AS year, CAST(count(subscription_id) AS BIGINT) AS active_subs
FROM (SELECT CAST(unnest(range({FIRST}, {LAST + 1})) AS INT) AS y) t
LEFT JOIN raw_subscriptions ON start_date <= make_date(y, 12, 31) AND (end_date IS NULL OR end_date > make_date(y, 12, 31)) GROUP BY y""",
    "cogs_by_year": """SELECT CAST(year(entry_date) AS INT) AS year, CAST(sum(debit_amount) AS DOUBLE) AS cogs,
  CAST(sum(CASE WHEN account_code <> '5300' THEN debit_amount ELSE 0 END) AS DOUBLE) AS vendor_cogs,
  CAST(sum(CASE WHEN account_code = '5300' THEN debit_amount ELSE 0 END) AS DOUBLE) AS payroll_cogs
FROM raw_journal_entries WHERE account_code IN ('5000', '5100', '5200', '5300') GROUP BY 1""",
    "churn_summary": f"""SELECT count(CASE WHEN status = 'Churned' THEN 1 END) AS churned, {N} AS total,
  {pct("count(CASE WHEN status = 'Churned' THEN 1 END)", "count(*)", 1)} AS churn_pct FROM raw_subscriptions""",
}
DERIVED["fact_invoices_bucketed"] = doubles("fact_invoices", *LINE_MONEY)
_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL"
_RUNS = "raw_subscriptions ON start_date <= day AND (end_date IS NULL OR end_date > day)"
DERIVED["subscriptions_on_days"] = f"""SELECT day, CAST(count(subscription_id) AS BIGINT) AS active_subs, CAST(coalesce(sum(mrr), 0) AS DOUBLE) AS mrr
FROM ({_DAYS}) d LEFT JOIN {_RUNS} GROUP BY day"""
DERIVED["interval_join"] = f"SELECT day, subscription_id FROM ({_DAYS}) d JOIN {_RUNS} WHERE day(day) = 1"
DERIVED["annual_summary"] = f"""SELECT year, CAST(sub AS DOUBLE) AS subscription_revenue, CAST(svc AS DOUBLE) AS services_revenue,
  CAST(sub + svc AS DOUBLE) AS total_revenue, CAST(cogs AS DOUBLE) AS cogs, CAST(pay - pay_cogs AS DOUBLE) AS payroll_opex,
  CAST(spend - ven_cogs AS DOUBLE) AS vendor_opex, active_subs, CAST(sub + svc - cogs AS DOUBLE) AS gross_profit,
  coalesce({pct("(sub + svc - cogs)", "(sub + svc)", 1)}, 0) AS gross_margin_pct,
  CAST(sub + svc - cogs - (pay - pay_cogs) - (spend - ven_cogs) AS DOUBLE) AS net
FROM (SELECT a.year, a.active_subs,
    coalesce((SELECT sum(total_amount) FROM raw_invoices WHERE invoice_type = 'Subscription' AND year(invoice_date) = a.year), 0) AS sub,
    coalesce((SELECT sum(total_amount) FROM raw_invoices WHERE invoice_type = 'Professional Services' AND year(invoice_date) = a.year), 0) AS svc,
    coalesce((SELECT sum(debit_amount) FROM raw_journal_entries WHERE account_code IN ('5000', '5100', '5200', '5300') AND year(entry_date) = a.year), 0) AS cogs,
    coalesce((SELECT sum(debit_amount) FROM raw_journal_entries WHERE account_code = '5300' AND year(entry_date) = a.year), 0) AS pay_cogs,
    coalesce((SELECT sum(debit_amount) FROM raw_journal_entries WHERE account_code IN ('5000', '5100', '5200') AND year(entry_date) = a.year), 0) AS ven_cogs,
    coalesce((SELECT sum(gross_pay) FROM raw_payroll WHERE year(pay_period_start) = a.year), 0) AS pay,
    coalesce((SELECT sum(amount) FROM raw_vendor_bills WHERE year(bill_date) = a.year), 0) AS spend
  FROM ({DERIVED["active_subs_at_year_end"]}) a) z"""

_LATEST = """SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) e WHERE n = 1"""
_UPSERTED = "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, CASE WHEN lower(trim(status)) = 'paid' THEN 'Closed' ELSE status END AS status) FROM raw_invoices"
_TOKENS = "('', 'N/A')"  # of the missing-value tokens those that the test tables hold


def _awkward(column: str, key: str) -> str:
    """The planted texts: quotes, doubled quotes, commas, backslashes, line breaks."""
    return (
        f"CASE CAST(substr({key}, 2) AS BIGINT) % 6 WHEN 0 THEN {column} || ' \"Best\" Ltd' WHEN 1 THEN '\"' || {column} || '\"' "
        f"WHEN 2 THEN {column} || ', \\ and \"\", too' WHEN 3 THEN {column} || chr(10) || 'line two' WHEN 4 THEN {column} || '\\' ELSE {column} END"
    )


_ODD = {"raw_customers": ("company_name", "customer_id"), "raw_products": ("description", "product_id"), "raw_vendors": ("vendor_name", "vendor_id")}
_ODD["raw_invoices"] = ("status", "invoice_id")


def _odd(table: str) -> str:
    column, key = _ODD[table]
    return f"(SELECT * REPLACE ({_awkward(column, key)} AS {column}) FROM {table}) t"


_NULLED = ", ".join(
    f"CASE WHEN {c} NOT IN {_TOKENS} THEN {c} END AS {c}"
    for c in ("customer_id", "company_name", "industry", "segment", "region", "billing_email")
)


def _as_text(table: str) -> str:
    cells = []
    for c, kind in raw_columns(table):
        text = f"CAST({c} AS VARCHAR)" if not kind.startswith("decimal") else f"CAST(CAST({c} AS DECIMAL(15,2)) AS VARCHAR)"
        cells.append(f"coalesce(CASE WHEN {text} NOT IN {_TOKENS} THEN {text} END, '-')")
    return f"SELECT '{table}' AS table_name, concat_ws('|', {', '.join(cells)}) AS row_text FROM {_odd(table)}"


SOURCES = {
    "read_raw_csv": staged("raw_customers").replace("FROM raw_customers", f"FROM {_odd('raw_customers')}"),
    "read_raw_csv_inferred": f"SELECT {_NULLED}, CAST(credit_limit AS DOUBLE) AS credit_limit, created_at, is_active FROM {_odd('raw_customers')}",
    "read_csv_dir": _as_text("raw_customers") + " UNION ALL " + _as_text("raw_products"),
    "load_csv_dir": _as_text("raw_products") + " UNION ALL " + _as_text("raw_vendors"),
    "source": staged("raw_customers"),
    "ref": staged("raw_subscriptions"),
    "raw_schemas": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, CAST(count({c}) AS BIGINT) AS n FROM {t}"
        for t in RAW_TABLES
        if t != "raw_chart_of_accounts"
        for c, kind in raw_columns(t)
    ),
    "write_csv": staged("raw_invoices").replace("FROM raw_invoices", f"FROM {_odd('raw_invoices')}"),
    "load_replace": doubles("fact_payments", "amount"),
    "load_replace_simple": doubles("fact_payments", "amount"),
    "materialize_table": doubles("fact_vendor_bills", "amount"),
    "materialize_incremental": staged("raw_invoices").replace(
        " FROM ",
        ", CASE WHEN CAST(substr(invoice_id, 2) AS BIGINT) % 50 = 7 OR (CAST(substr(invoice_id, 2) AS BIGINT) % 20 = 3 "
        "AND status IS DISTINCT FROM 'Draft') THEN TIMESTAMP '2001-08-15 06:00:00' ELSE TIMESTAMP '2001-08-13 06:00:00' END "
        "AS ingestion_timestamp FROM ",
    ),
    "load_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, {N} AS n FROM {t}" for t in RAW_TABLES),
    "run_query": "SELECT * REPLACE ("
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MRR_MONEY)
    + ", "
    + ", ".join(
        f"strftime({c}, '%Y-%m-%d') AS {c}"
        for c in ("start_date", "end_date", "created_at", "updated_at", "start_month", "end_month")
    )
    + ") FROM fact_subscriptions",
    "upsert": _UPSERTED,
    "upsert_table": _UPSERTED,
    "upsert_table_as_of": """SELECT version, payment_method, CAST(count(*) AS BIGINT) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM (
  SELECT CAST(v AS INT) AS version, amount, CASE WHEN part < v - 1 THEN 'batch ' || part ELSE payment_method END AS payment_method
  FROM (SELECT *, CAST(substr(payment_id, 2) AS BIGINT) % 40 AS part FROM raw_payments) p, (SELECT unnest([1, 2, 3]) AS v) x
  WHERE part <> 1 OR v = 3) held GROUP BY ALL""",
    "dedupe_latest": _LATEST.format(cols="user_id, ts, event_id, event_type, value, props"),
    "stream_upsert": _LATEST.format(cols="event_id, ts, user_id, event_type, value, props"),
    "stream_dedupe": "SELECT DISTINCT ON (event_id) event_id, user_id, event_type, value, props FROM events",
}

_ARRIVALS = """arrivals AS (
  SELECT event_id, ts, CASE WHEN event_id % 10 = 3 THEN 2 WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS run
  FROM events
), sent AS (
  SELECT * FROM arrivals UNION ALL SELECT event_id, ts, least(run + 1, 2) FROM arrivals WHERE event_id % 7 = 1
), bounds AS (
  SELECT b.run, date_trunc('milliseconds', max(s.ts)) - INTERVAL 5 DAY AS bound FROM (SELECT unnest([1, 2]) AS run) b JOIN sent s ON s.run < b.run GROUP BY b.run
), marked AS (
  SELECT event_id, ts, bound, coalesce(ts <= bound, false) AS late, row_number() OVER (PARTITION BY event_id ORDER BY s.run) AS nth
  FROM sent s LEFT JOIN bounds USING (run)
)"""
SOURCES["stream_late"] = f"""WITH {_ARRIVALS}
SELECT CASE WHEN late THEN 'late' ELSE 'kept' END AS outcome, event_id,
  CASE WHEN late THEN (epoch_us(bound) - epoch_us(ts)) / 1000000 END AS late_by_seconds, CAST(1 AS BIGINT) AS n
FROM marked WHERE late OR nth = 1
UNION ALL SELECT 'repeated', NULL, NULL, {N} FROM marked WHERE NOT late AND nth > 1"""

# The bronze models check the same rows as the raw tables they project.
_RAW_OF = {bronze_name(t): t for t in RAW_TABLES}


def _model(name: str) -> str:
    if name == "fact_vendor_bills":
        return f"(SELECT *, {AS_OF} AS silver_inserted_at FROM fact_vendor_bills)"
    return _RAW_OF.get(name, name)


def _accepted(model: str, label: str, column: str, values: list) -> str:
    listed = ", ".join(f"'{str(v).lower() if isinstance(v, bool) else v}'" for v in values)
    return (
        f"SELECT '{label}' AS model, '{column}' AS column_name, CAST({column} AS VARCHAR) AS value, {N} AS failures "
        f"FROM {model} WHERE CAST({column} AS VARCHAR) NOT IN ({listed}) GROUP BY 3"
    )


# Planted faults: rows that come twice, and parents that are missing.
_TWICE = {
    "stg_customers": "CAST(substr(customer_id, 2) AS BIGINT) % 30 = 0",
    "stg_invoices": "CAST(substr(invoice_id, 2) AS BIGINT) % 50 = 0",
    "fact_payments": "CAST(substr(payment_id, 2) AS BIGINT) % 70 = 0",
    "dim_vendors": "CAST(substr(vendor_id, 2) AS BIGINT) % 9 = 0",
    "fact_journal_entries": "account_code = '2100'",
}
_GONE = {
    "stg_customers": "CAST(substr(customer_id, 2) AS BIGINT) % 40 = 0",
    "stg_products": "CAST(substr(product_id, 2) AS BIGINT) % 25 = 0",
    "stg_chart_of_accounts": "account_code = '6400'",
}


def _twice(model: str) -> str:
    again = f" UNION ALL SELECT * FROM {_model(model)} WHERE {_TWICE[model]}" if model in _TWICE else ""
    return f"(SELECT * FROM {_model(model)}{again})"


def _left(model: str) -> str:
    return f"(SELECT * FROM {_RAW_OF[model]} WHERE NOT ({_GONE.get(model, 'false')}))"


QUALITY = {
    "dq_not_null": " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, {N} AS failures FROM {_model(m)} WHERE {c} IS NULL"
        for m, cols in NOT_NULL.items()
        for c in cols
    ),
    "dq_unique": " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, {N} AS failures FROM "
        f"(SELECT {c} FROM {_twice(m)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        for m, c in UNIQUE.items()
    ),
    "dq_accepted_values": " UNION ALL ".join(
        [_accepted(m, m, c, v) for (m, c), v in ACCEPTED.items()]
        + [_accepted("fact_vendor_bills", "fact_vendor_bills (short list)", "status", ["PAID"])]
    ),
    "dq_gl_balance": UNBALANCED.format(
        source="(SELECT * FROM raw_journal_entries WHERE NOT (transaction_type = 'PAYMENT' AND entry_id LIKE '%-2' "
        "AND TRY_CAST(substr(transaction_ref, 2) AS BIGINT) % 83 = 0)) j"
    ),
    "dq_orphans": " UNION ALL ".join(
        f"SELECT '{child}' AS model, '{c}' AS column_name, '{parent}' AS parent, {N} AS failures FROM {_left(child)} x "
        f"WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_left(parent)} p WHERE p.{key} = x.{c})"
        for child, c, parent, key in FOREIGN_KEYS
    ),
}


def all_statements() -> dict[str, str]:
    """Oracle SQL of every registered query."""
    bodies = {
        **SOURCES,
        **{bronze_name(t): staged(t) for t in RAW_TABLES if t != "raw_chart_of_accounts"},
        **{m: doubles(m, *money) for m, money in MODEL_MONEY.items() if m != "dim_accounts"},
        **SERVING,
        **{n: doubles(n, *LEG_MONEY) for n in MODELS if n.startswith("post_")},
        **DERIVED,
        **QUALITY,
    }
    return {name: statement(body) for name, body in bodies.items()}
