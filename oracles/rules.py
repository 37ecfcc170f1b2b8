"""What the checks and loads must be held against, stated here apart from the code under test."""

# Columns that must not be NULL.
NOT_NULL = {
    "stg_chart_of_accounts": ["account_id", "account_code"],
    "stg_customers": ["customer_id"],
    "stg_products": ["product_id"],
    "stg_employees": ["employee_id"],
    "stg_vendors": ["vendor_id"],
    "stg_subscriptions": ["subscription_id", "customer_id", "product_id"],
    "stg_invoices": ["invoice_id", "customer_id", "sales_rep_id"],
    "stg_invoice_lines": ["line_id", "invoice_id", "product_id"],
    "stg_payments": ["payment_id", "invoice_id", "customer_id"],
    "stg_vendor_bills": ["bill_id", "vendor_id", "expense_account_id"],
    "stg_payroll": ["payroll_id", "employee_id"],
    "stg_journal_entries": ["entry_id", "transaction_ref", "account_id"],
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id", "product_name", "created_at"],
    "dim_employees": ["employee_id", "full_name", "hire_date"],
    "dim_accounts": ["account_id", "account_code", "account_name"],
    "dim_vendors": ["vendor_id", "vendor_name", "created_at"],
    "fact_invoices": ["invoice_id", "customer_id", "invoice_date", "invoice_status"],
    "fact_payments": ["payment_id", "invoice_id", "customer_id", "payment_date"],
    "fact_journal_entries": ["entry_id", "transaction_ref", "account_id", "account_code", "entry_date"],
    "fact_subscriptions": ["subscription_id", "customer_id", "product_id", "status", "start_date"],
    "fact_payroll": ["payroll_id", "employee_id"],
    "fact_vendor_bills": ["bill_id", "vendor_id", "expense_account_id", "amount", "status", "is_overdue", "days_past_due", "silver_inserted_at"],
    "rpt_pl_statement": ["entry_month", "entry_quarter", "entry_year", "account_type", "account_name", "account_type_sort_key", "financial_statement_line_item"],
}

# The key column of every model.
UNIQUE = {
    "stg_chart_of_accounts": "account_id",
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_employees": "employee_id",
    "stg_vendors": "vendor_id",
    "stg_subscriptions": "subscription_id",
    "stg_invoices": "invoice_id",
    "stg_invoice_lines": "line_id",
    "stg_payments": "payment_id",
    "stg_vendor_bills": "bill_id",
    "stg_payroll": "payroll_id",
    "stg_journal_entries": "entry_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_employees": "employee_id",
    "dim_accounts": "account_id",
    "dim_vendors": "vendor_id",
    "fact_payments": "payment_id",
    "fact_journal_entries": "entry_id",
    "fact_subscriptions": "subscription_id",
    "fact_payroll": "payroll_id",
    "fact_vendor_bills": "bill_id",
}

# What a column may hold.
ACCEPTED = {
    ("fact_payroll", "pay_type"): ["SALARY", "BONUS", "HOURLY", "COMMISSION", "SEVERANCE"],
    ("fact_vendor_bills", "status"): ["PAID", "OPEN", "PENDING", "VOID", "REJECTED"],
    ("fact_vendor_bills", "is_overdue"): [True, False],
    ("rpt_pl_statement", "account_type"): ["REVENUE", "COGS", "OPEX"],
}

# Child table, column, parent table, parent key.
FOREIGN_KEYS = [
    ("stg_employees", "manager_id", "stg_employees", "employee_id"),
    ("stg_vendors", "expense_account_code", "stg_chart_of_accounts", "account_code"),
    ("stg_subscriptions", "customer_id", "stg_customers", "customer_id"),
    ("stg_subscriptions", "product_id", "stg_products", "product_id"),
    ("stg_invoices", "customer_id", "stg_customers", "customer_id"),
    ("stg_invoices", "subscription_id", "stg_subscriptions", "subscription_id"),
    ("stg_invoices", "sales_rep_id", "stg_employees", "employee_id"),
    ("stg_invoice_lines", "invoice_id", "stg_invoices", "invoice_id"),
    ("stg_invoice_lines", "product_id", "stg_products", "product_id"),
    ("stg_payments", "invoice_id", "stg_invoices", "invoice_id"),
    ("stg_payments", "customer_id", "stg_customers", "customer_id"),
    ("stg_vendor_bills", "vendor_id", "stg_vendors", "vendor_id"),
    ("stg_vendor_bills", "expense_account_id", "stg_chart_of_accounts", "account_id"),
    ("stg_payroll", "employee_id", "stg_employees", "employee_id"),
    ("stg_journal_entries", "account_id", "stg_chart_of_accounts", "account_id"),
]

# Columns and types of the raw tables.
RAW_COLUMNS = {
    "raw_chart_of_accounts": (
        "account_id string, account_code string, account_name string, account_type string, account_subtype "
        "string, is_active boolean"
    ),
    "raw_customers": (
        "customer_id string, company_name string, industry string, segment string, region string, "
        "billing_email string, credit_limit decimal(15,2), created_at date, is_active boolean"
    ),
    "raw_products": (
        "product_id string, product_name string, product_category string, unit_price decimal(15,2), "
        "description string, is_active boolean, created_at date"
    ),
    "raw_employees": (
        "employee_id string, first_name string, last_name string, department string, role string, salary "
        "decimal(15,2), hire_date date, is_active boolean, created_at date, manager_id string, cost_center "
        "string, salary_account string"
    ),
    "raw_vendors": (
        "vendor_id string, vendor_name string, vendor_category string, payment_terms_days int, "
        "expense_account_code string, is_active boolean, created_at date"
    ),
    "raw_subscriptions": (
        "subscription_id string, customer_id string, product_id string, plan_name string, status string, mrr "
        "decimal(15,2), start_date date, end_date date, created_at date, updated_at date"
    ),
    "raw_invoices": (
        "invoice_id string, customer_id string, subscription_id string, sales_rep_id string, invoice_type "
        "string, invoice_date date, due_date date, status string, total_amount decimal(15,2), currency "
        "string, created_at date"
    ),
    "raw_invoice_lines": (
        "line_id string, invoice_id string, product_id string, description string, quantity int, unit_price "
        "decimal(15,2), discount_pct decimal(6,4), line_total decimal(15,2)"
    ),
    "raw_payments": (
        "payment_id string, invoice_id string, customer_id string, payment_date date, amount decimal(15,2), "
        "payment_method string, currency string, created_at date"
    ),
    "raw_vendor_bills": (
        "bill_id string, vendor_id string, expense_account_id string, bill_date date, due_date date, amount "
        "decimal(15,2), status string, description string, currency string, created_at date"
    ),
    "raw_payroll": (
        "payroll_id string, employee_id string, department string, pay_period_start date, pay_period_end "
        "date, gross_pay decimal(15,2), tax_withheld decimal(15,2), net_pay decimal(15,2), payment_date date, "
        "pay_type string, created_at date, cost_center string, salary_account string"
    ),
    "raw_journal_entries": (
        "entry_id string, transaction_ref string, transaction_type string, account_id string, account_code "
        "string, entry_date date, debit_amount decimal(15,2), credit_amount decimal(15,2), description "
        "string, created_at date"
    ),
}
