"""Common table expressions shared by the oracle statements.

Written directly in DuckDB SQL, independently of the DataFrame code: the
source mapping of FIXTURES.md, the staging projections, and the silver
dimensions and facts.  ``AS_OF`` is the run date of every query.
"""

AS_OF = "DATE '2001-08-02'"
AS_OF_TS = "TIMESTAMP '2001-08-02 00:00:00'"
EXTRACTED = "TIMESTAMP '2001-08-02 00:00:00'"
CAL_START = "DATE '2000-01-01'"
CAL_END_EXCL = "DATE '2004-08-02'"
NULL_TOKEN = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} AS VARCHAR), {NULL_TOKEN})" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def pad(prefix: str, number: str, width: int) -> str:
    """Prefix and number, padded to a least width."""
    return f"'{prefix}' || lpad(cast({number} AS VARCHAR), CAST(greatest({width}, length(cast({number} AS VARCHAR))) AS INTEGER), '0')"


def flawed(value: str, key: str, every: int, instead: str) -> str:
    """A value that is wrong in one of ``every`` rows."""
    return f"CASE WHEN ({key}) % {every} = {every // 2} THEN {instead} ELSE {value} END"


SOURCES = f"""
src_customers AS (
  SELECT {pad('CUST', 'c.c_custkey', 6)} AS customer_id,
         lower(split_part(c.c_name, '#', 1)) || split_part(c.c_name, '#', 2) || '@example.com' AS email,
         split_part(c.c_name, '#', 1) AS first_name,
         split_part(c.c_name, '#', 2) AS last_name,
         '+' || cast(c.c_custkey AS VARCHAR) AS phone_number,
         {flawed("(['UAE','KSA','Egypt','Kuwait'])[c.c_nationkey % 4 + 1]", 'c.c_custkey', 401, "'Oman'")} AS country,
         n.n_name AS city,
         cast(DATE '1999-09-01' + cast(c.c_custkey % 730 AS INTEGER) AS TIMESTAMP) AS registration_date,
         CASE WHEN c.c_custkey % 5 <> 0
              THEN cast(DATE '1999-09-01' + cast(c.c_custkey % 730 AS INTEGER) AS TIMESTAMP) + INTERVAL 30 DAY
         END AS last_login_date,
         {flawed("CASE c.c_custkey % 30 WHEN 0 THEN 'inactive' WHEN 1 THEN 'suspended' ELSE 'active' END", 'c.c_custkey', 409, "'blocked'")} AS status
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
src_merchants AS (
  SELECT {pad('MERCH', 's_suppkey', 4)} AS merchant_id,
         s_name AS merchant_name,
         {flawed("(['Fashion','Electronics','Home & Garden','Beauty','Sports','Grocery','Restaurants','Travel'])[s_suppkey % 8 + 1]", 's_suppkey', 41, "'Other'")} AS category,
         {flawed("(['UAE','KSA','Egypt','Kuwait'])[s_nationkey % 4 + 1]", 's_suppkey', 43, "'Oman'")} AS country,
         {flawed("(['direct','marketplace','platform'])[s_suppkey % 3 + 1]", 's_suppkey', 47, "'manual'")} AS integration_type,
         cast(DATE '1998-09-01' + cast((s_suppkey * 37) % 1000 AS INTEGER) AS TIMESTAMP) AS onboarding_date,
         {flawed("CASE s_suppkey % 20 WHEN 0 THEN 'inactive' WHEN 1 THEN 'pending' ELSE 'active' END", 's_suppkey', 37, "'closed'")} AS status
  FROM supplier
),
src_orders AS (
  SELECT o.o_orderkey,
         {flawed('cast(round(o.o_totalprice * 100) AS BIGINT) // 500', 'o.o_orderkey', 311, '0')} AS cents,
         {pad('TXN', 'o.o_orderkey', 8)} AS transaction_id,
         {flawed(pad('CUST', 'o.o_custkey', 6), 'o.o_orderkey', 293, "'CUST-GONE'")} AS customer_id,
         CASE WHEN o.o_orderkey % 283 = 141 THEN 'MERCH-GONE'
              WHEN o.o_orderpriority = '1-URGENT' THEN 'MERCH0000'
              WHEN li.supp IS NULL OR li.supp % 25 = 24 THEN NULL
              ELSE {pad('MERCH', 'li.supp', 4)} END AS merchant_id,
         cast(DATE '2001-08-01' - cast(date_diff('day', DATE '1995-01-01', cast(o.o_orderdate AS DATE)) % 365 AS INTEGER) AS TIMESTAMP)
           + to_seconds(o.o_orderkey % 86400) AS transaction_date,
         {flawed("(['AED','SAR','EGP','KWD'])[o.o_orderkey % 4 + 1]", 'o.o_orderkey', 307, "'XXX'")} AS currency,
         {flawed("(['credit_card','debit_card','bank_transfer'])[o.o_orderkey % 3 + 1]", 'o.o_orderkey', 317, "'cash'")} AS payment_method,
         CASE WHEN o.o_orderkey % 313 = 156 THEN 'unknown'
              WHEN o.o_custkey % 50 = 49 THEN 'pending'
              WHEN o.o_orderkey % 100 < 85 THEN 'completed'
              WHEN o.o_orderkey % 100 < 90 THEN 'pending'
              WHEN o.o_orderkey % 100 < 95 THEN 'failed'
              WHEN o.o_orderkey % 100 < 98 THEN 'cancelled'
              ELSE 'refunded' END AS status
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS supp FROM lineitem GROUP BY l_orderkey) li
         ON o.o_orderkey = li.l_orderkey
),
src_transactions AS (
  SELECT transaction_id, customer_id, merchant_id, transaction_date, cents / 100.0 AS amount,
         currency, payment_method, status
  FROM src_orders
),
src_plans_k AS (
  SELECT o_orderkey, cents,
         {pad('PLAN', 'o_orderkey', 8)} AS plan_id,
         {flawed('transaction_id', 'o_orderkey', 337, "'TXN-GONE'")} AS transaction_id,
         customer_id, merchant_id, transaction_date AS plan_date,
         cents / 100.0 AS total_amount,
         cast({flawed('([3, 6, 12])[o_orderkey % 3 + 1]', 'o_orderkey', 331, '9')} AS BIGINT) AS installment_count,
         {flawed("CASE o_orderkey % 40 WHEN 0 THEN 'completed' WHEN 1 THEN 'defaulted' ELSE 'active' END", 'o_orderkey', 347, "'paused'")} AS status
  FROM src_orders
  WHERE status = 'completed'
),
src_payment_plans AS (
  SELECT plan_id, transaction_id, customer_id, merchant_id, plan_date, total_amount, installment_count,
         ((cents * 2 + installment_count) // (installment_count * 2)) / 100.0 AS first_installment_amount,
         status
  FROM src_plans_k
),
src_inst_base AS (
  SELECT p.plan_id, p.o_orderkey, p.cents, p.installment_count, p.plan_date, j AS installment_number,
         p.plan_date + to_months(cast(j - 1 AS INTEGER)) AS due_date,
         (p.o_orderkey * 31 + j * 17) % 100 AS h
  FROM src_plans_k p, range(1, p.installment_count + 1) r(j)
),
src_installments AS (
  SELECT 'INST' || substr(plan_id, 5) || '_' || cast(installment_number AS VARCHAR) AS installment_id,
         {flawed('plan_id', 'o_orderkey', 359, "'PLAN-GONE'")} AS plan_id, installment_number,
         ((cents * 2 + installment_count) // (installment_count * 2)) / 100.0 AS amount,
         due_date,
         CASE WHEN due_date > {AS_OF_TS} THEN NULL
              WHEN h >= 95 THEN NULL
              WHEN h >= 85 THEN due_date + to_days(cast(1 + h % 30 AS INTEGER))
              ELSE due_date - to_days(cast(h % 6 AS INTEGER)) END AS paid_date,
         CASE WHEN (o_orderkey * 12 + installment_number) % 353 = 176 THEN 'lost'
              WHEN due_date > {AS_OF_TS} THEN 'scheduled'
              WHEN h >= 95 THEN 'defaulted'
              WHEN h >= 85 THEN 'paid_late'
              ELSE 'paid' END AS status
  FROM src_inst_base,
       range(CASE WHEN o_orderkey % 367 = 183 AND installment_number = 1 THEN 2 ELSE 1 END) twice
),
src_user_events AS (
  SELECT cast(event_id AS VARCHAR) AS event_id,
         ts AS event_timestamp,
         CASE WHEN event_id % 5 <> 0 THEN {pad('CUST', 'user_id', 6)} END AS customer_id,
         {flawed("""CASE WHEN event_type = 'click' AND event_id % 3 = 0 THEN 'add_to_cart'
              ELSE (MAP {'click': 'product_view', 'view': 'app_open', 'error': 'search',
                         'signup': 'checkout', 'purchase': 'purchase'})[event_type] END""", 'event_id', 373, "'unknown'")} AS event_type,
         {flawed("(['android','ios','web'])[event_id % 3 + 1]", 'event_id', 379, "'tv'")} AS platform,
         CASE WHEN (event_id // 10) % 10 >= 3 THEN {pad('MERCH', 'merchant', 4)} END AS merchant_id,
         cast(user_id AS VARCHAR) || '-' || strftime(cast(ts AS DATE), '%Y-%m-%d') AS session_id,
         {flawed("(['mobile','tablet','desktop'])[event_id % 3 + 1]", 'event_id', 383, "'watch'")} AS device_type,
         {flawed("(['UAE','KSA','Egypt','Kuwait'])[event_id % 4 + 1]", 'event_id', 389, "'Oman'")} AS country
  FROM (SELECT * REPLACE (ts - to_days(8216) AS ts),
               CASE WHEN event_id % 2 = 0 THEN event_id // 2 % 100 ELSE event_id % 5000 END AS merchant
        FROM events)
)"""

BRONZE = f"""
bronze_customers AS (SELECT *, {EXTRACTED} AS _etl_extracted_at, 'postgres.customers' AS _etl_source FROM src_customers),
bronze_merchants AS (SELECT *, {EXTRACTED} AS _etl_extracted_at, 'postgres.merchants' AS _etl_source FROM src_merchants),
bronze_transactions AS (SELECT *, {EXTRACTED} AS _etl_extracted_at, 'postgres.transactions' AS _etl_source FROM src_transactions),
bronze_payment_plans AS (SELECT *, {EXTRACTED} AS _etl_extracted_at, 'postgres.payment_plans' AS _etl_source FROM src_payment_plans),
bronze_installments AS (SELECT *, {EXTRACTED} AS _etl_extracted_at, 'postgres.installments' AS _etl_source FROM src_installments),
bronze_user_events AS (SELECT *, {EXTRACTED} AS _etl_extracted_at, 'file.user_events' AS _etl_source FROM src_user_events)"""

STAGING = """
stg_customers AS (SELECT * EXCLUDE (_etl_source) FROM bronze_customers),
stg_merchants AS (SELECT * EXCLUDE (_etl_source) FROM bronze_merchants),
stg_transactions AS (SELECT * EXCLUDE (_etl_source) FROM bronze_transactions),
stg_payment_plans AS (SELECT * EXCLUDE (_etl_source) FROM bronze_payment_plans),
stg_installments AS (SELECT * EXCLUDE (_etl_source) FROM bronze_installments),
stg_user_events AS (SELECT * EXCLUDE (_etl_source) FROM bronze_user_events)"""

SILVER = f"""
dim_customers AS (
  SELECT {sk('customer_id')} AS customer_sk,
         customer_id, email, first_name, last_name, phone_number, country, city,
         registration_date, last_login_date, status,
         coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS full_name,
         _etl_extracted_at AS source_extracted_at
  FROM stg_customers
),
dim_merchants AS (
  SELECT {sk('merchant_id')} AS merchant_sk,
         merchant_id, merchant_name, category, country, integration_type, onboarding_date, status,
         date_diff('day', cast(onboarding_date AS DATE), {AS_OF}) AS days_since_onboarding,
         _etl_extracted_at AS source_extracted_at
  FROM stg_merchants
),
date_spine AS (
  SELECT cast(d AS DATE) AS date_day
  FROM range(cast({CAL_START} AS TIMESTAMP), cast({CAL_END_EXCL} AS TIMESTAMP), INTERVAL 1 DAY) t(d)
),
dim_dates AS (
  SELECT date_day AS date_key,
         date_day AS calendar_date,
         year(date_day) AS year,
         month(date_day) AS month,
         day(date_day) AS day_of_month,
         dayofweek(date_day) AS day_of_week,
         dayofyear(date_day) AS day_of_year,
         monthname(date_day) AS month_name,
         dayname(date_day) AS day_name,
         dayofweek(date_day) IN (0, 6) AS is_weekend,
         'Q' || cast(quarter(date_day) AS VARCHAR) AS quarter,
         strftime(date_day, '%Y-%m') AS year_month,
         date_day = {AS_OF} AS is_current_day,
         day(date_day) = 1 AS is_first_day_of_month,
         date_day = last_day(date_day) AS is_last_day_of_month
  FROM date_spine
),
fact_transactions AS (
  SELECT {sk('t.transaction_id')} AS transaction_sk,
         t.transaction_id, c.customer_sk, m.merchant_sk,
         cast(t.transaction_date AS DATE) AS transaction_date_key,
         t.transaction_date, t.amount, t.currency, t.payment_method, t.status,
         t._etl_extracted_at AS source_extracted_at
  FROM stg_transactions t
  LEFT JOIN dim_customers c ON t.customer_id = c.customer_id
  LEFT JOIN dim_merchants m ON t.merchant_id = m.merchant_id
),
plan_installment_metrics AS (
  SELECT plan_id, count(DISTINCT installment_id) AS total_installments,
         count(DISTINCT installment_id) FILTER (settled) AS paid_installments,
         count(DISTINCT installment_id) FILTER (status = 'defaulted') AS defaulted_installments,
         ifnull(CAST(sum(money) FILTER (settled) AS DOUBLE), 0) AS total_paid_amount,
         avg(CAST(paid_date AS DATE) - CAST(due_date AS DATE)) FILTER (status = 'paid_late') AS avg_days_late
  FROM (SELECT *, status IN ('paid', 'paid_late') AS settled, CAST(amount AS DECIMAL(18,2)) AS money
        FROM stg_installments)
  GROUP BY plan_id
),
fact_payment_plans AS (
  SELECT {sk('plan_id')} AS plan_sk, plan_id, transaction_sk, customer_sk, merchant_sk,
         CAST(plan_date AS DATE) AS plan_date_key, plan_date, total_amount, installment_count,
         first_installment_amount, status, ifnull(total_installments, 0) AS total_installments,
         ifnull(paid_installments, 0) AS paid_installments,
         ifnull(defaulted_installments, 0) AS defaulted_installments,
         ifnull(total_paid_amount, 0) AS total_paid_amount, avg_days_late,
         CASE WHEN total_amount > 0 THEN ifnull(total_paid_amount, 0) / total_amount END AS payment_completion_rate,
         _etl_extracted_at AS source_extracted_at
  FROM stg_payment_plans
       LEFT JOIN plan_installment_metrics USING (plan_id)
       LEFT JOIN (SELECT transaction_id, transaction_sk FROM fact_transactions) USING (transaction_id)
       LEFT JOIN (SELECT customer_id, customer_sk FROM dim_customers) USING (customer_id)
       LEFT JOIN (SELECT merchant_id, merchant_sk FROM dim_merchants) USING (merchant_id)
),
fact_customer_events AS (
  SELECT {sk('e.event_id')} AS event_sk,
         e.event_id, c.customer_sk, m.merchant_sk,
         cast(e.event_timestamp AS DATE) AS event_date_key,
         e.event_timestamp, e.event_type, e.platform, e.session_id, e.device_type, e.country,
         e._etl_extracted_at AS source_extracted_at
  FROM stg_user_events e
  LEFT JOIN dim_customers c ON e.customer_id = c.customer_id
  LEFT JOIN dim_merchants m ON e.merchant_id = m.merchant_id
)"""

PREAMBLE = "WITH " + ",".join([SOURCES, BRONZE, STAGING, SILVER])


def with_preamble(body: str) -> str:
    """Prefix a statement with all shared CTEs; ``body`` may add its own after a comma."""
    body = body.strip()
    if body.startswith(","):
        return PREAMBLE + body
    return PREAMBLE + "\n" + body
