"""Raw finance tables as DuckDB CTEs over the test tables (FIXTURES.md)."""

RAW = {
    "raw_chart_of_accounts": """
SELECT 'A' || code AS account_id, code AS account_code, name AS account_name, typ AS account_type, sub AS account_subtype, TRUE AS is_active
 FROM (VALUES
 ('1010','Cash and Cash Equivalents','Asset','Current Asset'),('1100','Accounts Receivable','Asset','Current Asset'),
 ('1200','Prepaid Expenses','Asset','Current Asset'),('1500','Equipment','Asset','Non-Current Asset'),
 ('1510','Accumulated Depreciation','Asset','Non-Current Asset'),('2000','Accounts Payable','Liability','Current Liability'),
 ('2100','Accrued Expenses','Liability','Current Liability'),('2200','Deferred Revenue','Liability','Current Liability'),
 ('2300','Loan Payable','Liability','Non-Current Liability'),('3000','Common Stock','Equity','Equity'),
 ('3100','Additional Paid-in Capital','Equity','Equity'),('3200','Retained Earnings','Equity','Equity'),
 ('4000','Subscription Revenue','Revenue','Operating Revenue'),('4100','Professional Services Revenue','Revenue','Operating Revenue'),
 ('4200','Setup Fees','Revenue','Operating Revenue'),('5000','Hosting and Infrastructure','COGS','Cost of Revenue'),
 ('5100','Third-party Software Costs','COGS','Cost of Revenue'),('5200','Professional Services Delivery','COGS','Cost of Revenue'),
 ('5300','Engineering - Product Delivery','COGS','Cost of Revenue'),('6000','Salaries - Engineering','OpEx','Personnel'),
 ('6010','Salaries - Sales','OpEx','Personnel'),('6020','Salaries - Customer Success','OpEx','Personnel'),
 ('6030','Salaries - G&A','OpEx','Personnel'),('6100','Sales and Marketing','OpEx','Sales & Marketing'),
 ('6200','Office and Facilities','OpEx','Overhead'),('6300','Professional Fees','OpEx','Overhead'),
 ('6400','Software and Tools','OpEx','Overhead'),('6500','Depreciation Expense','OpEx','Overhead')
 ) AS t(code, name, typ, sub)
""",
    "raw_customers": """
SELECT 'C' || CAST(c_custkey AS STRING) AS customer_id,
  CASE WHEN c_custkey % 33 = 0 THEN '  ' || c_name WHEN c_custkey % 34 = 0 THEN upper(c_name) ELSE c_name END AS company_name,
  CASE WHEN c_custkey % 25 = 0 THEN NULL WHEN c_custkey % 26 = 0 THEN 'N/A' ELSE c_mktsegment END AS industry,
  CASE WHEN c_acctbal < 2500 THEN 'SMB' WHEN c_acctbal < 7500 THEN 'Mid-Market' ELSE 'Enterprise' END AS segment,
  CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE r_name END AS region,
  CASE WHEN c_custkey % 40 = 0 THEN ' ' ELSE '' END || 'billing' || CAST(c_custkey AS STRING) || '@' || lower(n_name) || '.example' AS billing_email,
  CAST(10000 * (1 + c_custkey % 10) AS DECIMAL(15,2)) AS credit_limit,
  DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS created_at, TRUE AS is_active
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
    "raw_products": """
SELECT 'P' || CAST(p_partkey AS STRING) AS product_id, p_name AS product_name,
  CASE WHEN p_type IN ('PROMO','SMALL') THEN 'Professional Services' ELSE 'Subscription' END AS product_category,
  CAST(p_retailprice AS DECIMAL(15,2)) AS unit_price, p_brand || ' ' || p_type AS description, TRUE AS is_active, DATE '1994-12-01' AS created_at
 FROM part
""",
    "raw_employees": """
SELECT 'E' || CAST(user_id AS STRING) AS employee_id,
  CASE WHEN user_id % 10 = 3 THEN ' First' ELSE 'First' END || CAST(user_id AS STRING) AS first_name,
  'Last' || CAST(user_id AS STRING) AS last_name,
  CASE CAST(user_id % 4 AS INT) WHEN 0 THEN 'Engineering' WHEN 1 THEN 'Sales' WHEN 2 THEN 'Customer Success' ELSE 'G&A' END AS department,
  CASE WHEN user_id % 8 = 0 THEN 'COGS' ELSE 'OPEX' END AS cost_center,
  CASE WHEN user_id % 8 = 0 THEN '5300' WHEN user_id % 4 = 0 THEN '6000' WHEN user_id % 4 = 1 THEN '6010' WHEN user_id % 4 = 2 THEN '6020' ELSE '6030' END AS salary_account,
  CASE WHEN user_id % 50 = 7 THEN NULL ELSE 'Role ' || CAST(user_id % 5 AS STRING) END AS role,
  CAST(50000 + (user_id * 997) % 60000 AS DECIMAL(15,2)) AS salary,
  DATE '1994-01-01' + CAST(user_id % 365 AS INT) AS hire_date, TRUE AS is_active, DATE '1995-01-01' AS created_at,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'E' || CAST(user_id - user_id % 10 AS STRING) END AS manager_id
 FROM (SELECT DISTINCT user_id FROM events) u
""",
    "raw_vendors": """
SELECT 'V' || CAST(s_suppkey AS STRING) AS vendor_id, s_name AS vendor_name, n_name AS vendor_category,
  CAST(15 * (s_suppkey % 4) AS INT) AS payment_terms_days,
  CASE CAST(s_suppkey % 7 AS INT) WHEN 0 THEN '5000' WHEN 1 THEN '5100' WHEN 2 THEN '6100' WHEN 3 THEN '6200' WHEN 4 THEN '6300' ELSE '6400' END AS expense_account_code,
  TRUE AS is_active, DATE '1994-12-01' AS created_at
 FROM supplier JOIN nation ON s_nationkey = n_nationkey
""",
    "cust_span": """
SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d0, CAST(max(o_orderdate) AS DATE) AS d1 FROM orders GROUP BY o_custkey
""",
    "subs0": """
SELECT o_custkey AS k, CASE WHEN o_custkey % 3 = 0 THEN d1 ELSE d0 END AS start_date FROM cust_span
""",
    "raw_subscriptions": """
SELECT 'S' || CAST(k AS STRING) AS subscription_id, 'C' || CAST(k AS STRING) AS customer_id, 'P' || CAST(k % 100 AS STRING) AS product_id,
  'Plan ' || CAST(k % 5 AS STRING) AS plan_name,
  CASE WHEN k % 25 = 0 THEN 'churned ' WHEN k % 5 = 0 THEN 'Churned' WHEN k % 27 = 0 THEN 'ACTIVE' ELSE 'Active' END AS status,
  CAST(99 + (k % 25) * 100 AS DECIMAL(15,2)) AS mrr, start_date,
  CASE WHEN k % 5 = 0 THEN start_date + CAST(30 + k % 400 AS INT) WHEN k % 7 = 0 THEN DATE '2001-09-30' ELSE NULL END AS end_date,
  start_date AS created_at, DATE '2001-08-01' AS updated_at FROM subs0
""",
    "raw_invoices": """
SELECT 'I' || CAST(o_orderkey AS STRING) AS invoice_id, 'C' || CAST(o_custkey AS STRING) AS customer_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'S' || CAST(o_custkey AS STRING) END AS subscription_id,
  'E' || CAST(o_orderkey % 40 AS STRING) AS sales_rep_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Professional Services' ELSE 'Subscription' END AS invoice_type,
  CAST(o_orderdate AS DATE) AS invoice_date, CAST(o_orderdate AS DATE) + 30 AS due_date,
  CASE WHEN o_orderkey % 25 = 0 THEN lower(st) WHEN o_orderkey % 26 = 0 THEN upper(st) WHEN o_orderkey % 27 = 0 THEN st || ' ' ELSE st END AS status,
  CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount, CASE WHEN o_orderkey % 50 = 0 THEN 'usd' ELSE 'USD' END AS currency,
  CAST(o_orderdate AS DATE) AS created_at
 FROM (SELECT *, CASE WHEN o_orderkey % 8 = 7 THEN 'Open' WHEN o_orderkey % 8 = 6 THEN 'Overdue' ELSE 'Paid' END AS st FROM orders) o
""",
    "raw_invoice_lines": """
SELECT 'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_quantity AS STRING) AS line_id,
  'I' || CAST(l_orderkey AS STRING) AS invoice_id, 'P' || CAST(l_partkey AS STRING) AS product_id,
  CASE WHEN l_orderkey % 33 = 0 THEN '  Line item' ELSE 'Line item' END AS description, CAST(l_quantity AS INT) AS quantity,
  CAST(900 + l_partkey % 1000 AS DECIMAL(15,2)) AS unit_price, CAST(round(l_discount * 100, 2) AS DECIMAL(6,4)) AS discount_pct,
  CAST(CAST(l_quantity AS INT) * CAST(900 + l_partkey % 1000 AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(15,2)) AS line_total
 FROM lineitem
""",
    "raw_payments": """
SELECT 'R' || substr(invoice_id, 2) AS payment_id, invoice_id, customer_id,
  invoice_date + CAST(3 + CAST(substr(invoice_id, 2) AS INT) % 30 AS INT) AS payment_date, total_amount AS amount,
  CASE CAST(substr(invoice_id, 2) AS INT) % 5 WHEN 0 THEN 'ACH' WHEN 1 THEN 'Wire' WHEN 2 THEN 'Credit Card' WHEN 3 THEN 'Check' ELSE 'ach ' END AS payment_method,
  currency, invoice_date AS created_at
 FROM raw_invoices WHERE lower(trim(status)) = 'paid'
""",
    "vb": """
SELECT l_suppkey AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) * 0.25 AS DECIMAL(15,2)) AS amount
 FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE)
""",
    "raw_vendor_bills": """
SELECT 'B' || CAST(k AS STRING) || '-' || CAST(m AS STRING) AS bill_id, 'V' || CAST(k AS STRING) AS vendor_id, 'A' || expense_account_code AS expense_account_id,
  m + CAST(1 + k % 6 AS INT) AS bill_date, m + CAST(1 + k % 6 AS INT) + payment_terms_days AS due_date, amount,
  CASE WHEN (k + month(m)) % 10 = 0 THEN 'Open' WHEN (k + month(m)) % 31 = 0 THEN 'paid ' ELSE 'Paid' END AS status,
  vendor_name || ' -- ' || CAST(m AS STRING) AS description, CASE WHEN k % 50 = 0 THEN 'usd' ELSE 'USD' END AS currency, m + CAST(1 + k % 6 AS INT) AS created_at
 FROM vb JOIN raw_vendors ON vendor_id = 'V' || CAST(k AS STRING)
""",
    "months": """
SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
""",
    "pay0": """
SELECT employee_id, department, cost_center, salary_account, m, CAST(salary / 12 AS DECIMAL(15,2)) AS g FROM raw_employees CROSS JOIN months
""",
    "pay1": """
SELECT employee_id, department, cost_center, salary_account, m, last_day(m) AS pe, g AS gross_pay, CAST(g * 0.25 AS DECIMAL(15,2)) AS tax_withheld, last_day(m) + 2 AS payment_date, 'Salary' AS pay_type FROM pay0
 UNION ALL
 SELECT employee_id, department, cost_center, salary_account, m, last_day(m), CAST(g * 0.25 AS DECIMAL(15,2)), CAST(CAST(g * 0.25 AS DECIMAL(15,2)) * 0.37 AS DECIMAL(15,2)), last_day(m), 'bonus ' FROM pay0 WHERE month(m) = 12
""",
    "raw_payroll": """
SELECT 'Y' || employee_id || '-' || CAST(m AS STRING) || '-' || upper(trim(pay_type)) AS payroll_id, employee_id, department, cost_center, salary_account, m AS pay_period_start, pe AS pay_period_end,
  gross_pay, tax_withheld, CAST(gross_pay - tax_withheld AS DECIMAL(15,2)) AS net_pay, payment_date, pay_type, pe AS created_at FROM pay1
""",
}
