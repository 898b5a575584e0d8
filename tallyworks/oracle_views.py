"""Independent DuckDB SQL for every canonical table and model, used only to verify results.

Each entry is one common table expression. Amounts are exact decimals; ratios are rounded with
integer arithmetic because a decimal division is a floating-point number in that dialect.
"""

from __future__ import annotations

import re


def exact_ratio(num: str, den: str, digits: int = 4, width: int = 18, factor: int = 1) -> str:
    """``num * factor / den`` rounded half away from zero, NULL unless ``den`` is positive."""
    n = f"CAST(({num}) * 100 AS HUGEINT)"
    d = f"CAST(({den}) * 100 AS HUGEINT)"
    k = 10**digits * factor
    unit = "0." + "0" * (digits - 1) + "1"
    return (
        f"CASE WHEN ({den}) > 0 THEN CAST(CAST(sign({n}) * ((2 * abs({n}) * {k} + {d}) // (2 * {d})) "
        f"AS DECIMAL(28,0)) * {unit} AS DECIMAL({width},{digits})) END"
    )


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


def _half(expr: str) -> str:
    return f"CAST(CAST((CAST(({expr}) * 100 AS BIGINT) + 1) // 2 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


_MONTHLY = f"CASE WHEN billing_interval = 'annual' THEN {exact_ratio('price', '12', 2)} ELSE price END"
_MONTHS_APART = (
    "CAST((year({a}) - year({b})) * 12 + month({a}) - month({b}) AS INTEGER)"
)
_KEY = "anonymous_id, event_type, coalesce(product_id, -1), event_timestamp"

VIEWS: dict[str, str] = {
    # -- canonical tables -----------------------------------------------------------------
    "raw_customers": """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name, c_name || '@Example.com' AS email,
               (SELECT CAST(min(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS signup_date,
               n_name AS region, r_name AS country
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "raw_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * 0.61234, 4) AS DECIMAL(18,4)) AS unit_cost,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) + 0.0045 AS DECIMAL(18,4)) AS unit_price, p_size <= 47 AS is_active
        FROM part""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled' ELSE 'refunded' END AS status,
               o_orderpriority AS channel
        FROM orders""",
    "raw_lines": """
        SELECT l_orderkey * 100 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_linenumber AS n,
               min(l_partkey) AS product_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
               CAST(CAST((2 * CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 10000 AS HUGEINT)
                          + sum(CAST(l_quantity AS BIGINT))) // (2 * sum(CAST(l_quantity AS BIGINT)))
                    AS DECIMAL(28,0)) * 0.0001 AS DECIMAL(18,4)) AS unit_price,
               CAST(CAST(max(l_discount) AS DECIMAL(4,2)) * 0.33333 AS DECIMAL(9,8)) AS discount, min(l_returnflag) AS flag, min(l_linestatus) AS method
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "lines_priced": """
        SELECT *, CAST(round(CAST(quantity AS DECIMAL(6,0)) * unit_price * (1 - discount), 2) AS DECIMAL(18,2)) AS line_amount
        FROM raw_lines""",
    "raw_phases": """
        SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS s, min(o_orderkey) AS id,
               min(o_orderkey) % 4 + 1 AS plan
        FROM orders GROUP BY ALL""",
    "raw_timeline": """
        SELECT *, row_number() OVER w AS n, lag(s) OVER w AS prev_s, lag(id) OVER w AS prev_id,
               lag(plan) OVER w AS prev_plan, lead(s) OVER w AS next_s, lead(plan) OVER w AS next_plan
        FROM raw_phases WINDOW w AS (PARTITION BY customer_id ORDER BY s)""",
    "stg_billing__subscriptions": """
        SELECT id AS subscription_id, customer_id AS subscription_chain_id, customer_id, plan AS plan_id,
               s AS phase_start_date,
               CASE WHEN next_s - s > 180 THEN s + 180 WHEN next_s IS NOT NULL THEN next_s
                    WHEN id % 3 = 0 THEN s + 120 END AS phase_end_date,
               CASE WHEN n = 1 THEN CASE WHEN id % 5 = 0 THEN 'trial' ELSE 'new' END
                    WHEN s - prev_s > 180 THEN 'reactivation'
                    WHEN n = 2 AND prev_id % 5 = 0 THEN 'new'
                    WHEN plan >= prev_plan THEN 'upgrade' ELSE 'downgrade' END AS phase_type,
               n = 1 AND id % 5 = 0 AS is_trial,
               CASE WHEN next_s IS NULL AND id % 3 <> 0 THEN NULL
                    WHEN next_s IS NULL OR next_s - s > 180 THEN CASE WHEN id % 2 = 0 THEN 'cancelled' ELSE 'paused' END
                    WHEN next_plan >= plan THEN 'upgraded' ELSE 'downgraded' END AS ended_reason
        FROM raw_timeline""",
    "raw_price_list": """
        SELECT p_size % 6 + 1 AS plan_id, 'Plan ' || (p_size % 6 + 1) AS plan_name,
               CASE WHEN p_size % 2 = 0 THEN 'monthly' ELSE 'annual' END AS billing_interval, 'USD' AS currency,
               CAST(round(min(CAST(p_retailprice AS DECIMAL(18,2))) * CASE WHEN p_size % 2 = 0 THEN 0.01 ELSE 0.10 END, 2)
                    AS DECIMAL(18,2)) AS price
        FROM part GROUP BY p_size % 6, p_size % 2""",
    "stg_billing__plans": """
        SELECT CAST(plan_id AS BIGINT) AS plan_id, plan_name, billing_interval, currency,
               CAST(price AS DECIMAL(18,2)) AS price
        FROM raw_price_list""",
    "raw_billed": """
        WITH stop AS (SELECT last_day(max(o_orderdate)) AS d FROM orders),
        paid AS (SELECT sub.*, coalesce(phase_end_date, d) AS until, CASE WHEN plan_id IN (1, 3) THEN 1 ELSE 12 END AS step
                 FROM stg_billing__subscriptions sub, stop WHERE NOT is_trial),
        runs AS (SELECT *, CAST(phase_start_date + to_months(CAST((i + 1) * step AS INTEGER)) AS DATE) - 1 AS period_end
                 FROM paid, unnest(range(0, 1 + datediff('month', phase_start_date, until))) AS r(i))
        SELECT subscription_id * 1000 + i AS invoice_id, subscription_id, customer_id,
               CAST(phase_start_date + to_months(CAST(i * step AS INTEGER)) AS DATE) AS period_start, period_end,
               CAST(price AS DECIMAL(18,2)) AS price, subscription_id + 7 * i AS k
        FROM runs JOIN raw_price_list USING (plan_id) WHERE period_end <= until""",
    "stg_billing__invoices": """
        SELECT invoice_id, subscription_id, customer_id, period_start AS invoice_date, period_start, period_end,
               CAST(price + CASE WHEN k % 10 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS invoice_amount
        FROM raw_billed""",
    "stg_billing__invoice_lines": """
        SELECT invoice_id * 10 + 1 AS invoice_line_id, invoice_id, subscription_id, 'plan fee' AS description,
               CAST(1 AS BIGINT) AS quantity, price AS unit_amount, price AS line_amount FROM raw_billed
        UNION ALL
        SELECT invoice_id * 10 + 2, invoice_id, subscription_id, 'add-on', 1, 5, 5 FROM raw_billed WHERE k % 10 = 0""",
    "raw_attempts": f"""
        WITH due AS (SELECT b.*, invoice_amount AS amount FROM raw_billed b JOIN stg_billing__invoices USING (invoice_id)),
        tries AS (SELECT *, 0 AS t FROM due UNION ALL SELECT *, 1 FROM due WHERE k % 20 = 1)
        SELECT invoice_id * 10 + t AS payment_id, invoice_id, k,
               period_start + CAST(CASE WHEN k % 20 = 3 THEN 45 ELSE k % 4 END + 4 * t AS INTEGER) AS payment_date,
               CASE WHEN invoice_id % 2 = 0 THEN 'card' ELSE 'transfer' END AS payment_method, t = 1 AS is_retry,
               CASE WHEN k % 20 = 0 OR (k % 20 = 1 AND t = 0) THEN 'failed' ELSE 'succeeded' END AS payment_status,
               CASE WHEN k % 20 = 2 THEN {_half("amount")} ELSE amount END AS payment_amount
        FROM tries""",
    "stg_billing__payments": """
        SELECT payment_id, invoice_id, payment_date, payment_method, is_retry, payment_status, payment_amount
        FROM raw_attempts""",
    "stg_billing__refunds": f"""
        SELECT payment_id AS refund_id, payment_id, payment_date + CASE k % 23 WHEN 0 THEN 50 ELSE 20 END AS refund_date,
               CASE k % 23 WHEN 0 THEN 'returned' ELSE 'goodwill' END AS refund_reason,
               CASE k % 23 WHEN 0 THEN payment_amount ELSE {_half("payment_amount")} END AS refund_amount
        FROM raw_attempts WHERE payment_status = 'succeeded' AND k % 23 IN (0, 1)""",
    "stg_events__events": """
        WITH sent AS (SELECT *, 0 AS copy FROM events UNION ALL
                      SELECT *, 1000000000 FROM events WHERE event_id % 50 = 0)
        SELECT event_id + copy AS event_id, 'anon_' || user_id || '_' || event_id % 2 AS anonymous_id,
               CASE WHEN event_type IN ('signup', 'purchase') AND user_id % 5 <> 0 THEN user_id END AS customer_id,
               CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                    WHEN 'error' THEN 'checkout_start' ELSE event_type END AS event_type,
               ts + to_days(CAST(user_id % 20 * 30 - 8766 AS INTEGER)) AS event_timestamp,
               event_id % 200 AS product_id,
               CASE WHEN event_type = 'purchase' THEN event_id END AS order_id,
               CASE WHEN event_type = 'view' THEN props END AS search_query
        FROM sent""",
    "accounting_periods": """
        WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo,
                          date_trunc('month', max(o_orderdate)) + INTERVAL 4 MONTH AS hi FROM orders)
        SELECT CAST(row_number() OVER (ORDER BY m) AS INTEGER) AS period_id, CAST(m AS DATE) AS period_start_date,
               last_day(m) AS period_end_date,
               CASE WHEN m <= hi - INTERVAL 2 MONTH THEN last_day(m) + 10 END AS closed_at
        FROM b, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS t(m)""",
    "tax_rates": """
        SELECT n_name AS region, CAST(n_nationkey % 10 * 0.01 AS DECIMAL(6,4)) AS tax_rate
        FROM nation WHERE n_nationkey < (SELECT max(n_nationkey) FROM nation)""",
    # -- staging --------------------------------------------------------------------------
    "stg_customers": """
        SELECT customer_id, first_name, last_name, signup_date, region, country, lower(email) AS email,
               first_name || ' ' || last_name AS customer_name FROM raw_customers""",
    "stg_products": """
        SELECT product_id, product_name, category, CAST(unit_cost AS DECIMAL(18,2)) AS unit_cost,
               CAST(unit_price AS DECIMAL(18,2)) AS unit_price, is_active,
               CAST(round(unit_price - unit_cost, 2) AS DECIMAL(18,2)) AS unit_margin FROM raw_products""",
    "stg_orders": """
        SELECT order_id, customer_id, order_date, status AS order_status, channel AS order_channel FROM raw_orders""",
    "stg_order_items": """
        SELECT order_item_id, order_id, product_id, quantity, CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
               CAST(discount AS DECIMAL(6,4)) AS discount, line_amount FROM lines_priced""",
    "stg_payments": """
        SELECT order_item_id AS payment_id, l.order_id, order_date + 10 * n AS payment_date, method AS payment_method,
               CASE flag WHEN 'N' THEN 'succeeded' WHEN 'A' THEN 'failed' ELSE 'refunded' END AS payment_status,
               line_amount AS amount
        FROM lines_priced l JOIN raw_orders o USING (order_id)""",
    # -- retail ---------------------------------------------------------------------------
    "fct_order_items": """
        SELECT order_item_id, i.order_id, customer_id, order_date, order_status, order_channel, i.product_id,
               category AS product_category, quantity, i.unit_price, discount, line_amount
        FROM stg_order_items i, stg_orders o, stg_products p
        WHERE i.order_id = o.order_id AND i.product_id = p.product_id""",
    "int_order_payment_summary": """
        SELECT order_id, count(*) AS payment_attempt_count,
               CAST(coalesce(sum(amount) FILTER (payment_status = 'succeeded'), 0) AS DECIMAL(18,2)) AS amount_collected,
               count(*) FILTER (payment_status = 'succeeded') > 0 AS has_succeeded_payment,
               count(*) FILTER (payment_status = 'failed') > 0 AS has_failed_attempt,
               max(payment_date) AS last_payment_date
        FROM stg_payments GROUP BY order_id""",
    "dim_customers": """
        SELECT customer_id, customer_name, email, signup_date, region, country,
               min(order_date) AS first_order_date, max(order_date) AS most_recent_order_date,
               count(order_id) AS lifetime_order_count
        FROM stg_customers LEFT JOIN (SELECT * FROM stg_orders WHERE order_status = 'completed') USING (customer_id)
        GROUP BY ALL""",
    "dim_products": """
        SELECT product_id, product_name, category, unit_cost, unit_price, unit_margin, is_active FROM stg_products""",
    "dim_date": """
        SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year_number, CAST(quarter(d) AS INTEGER) AS quarter_number,
               CAST(month(d) AS INTEGER) AS month_number, CAST(day(d) AS INTEGER) AS day_of_month,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name,
               rpad(monthname(d), 9, ' ') AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate) + INTERVAL 12 MONTH,
                                                 INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
    "fct_orders": """
        SELECT order_id, customer_id, order_date, order_status, order_channel,
               coalesce(q, 0) AS item_quantity, coalesce(a, 0.00) AS order_amount,
               coalesce(amount_collected, 0.00) AS amount_collected,
               coalesce(payment_attempt_count, 0) AS payment_attempt_count,
               coalesce(has_succeeded_payment, false) AS has_succeeded_payment,
               CAST(coalesce(a, 0.00) - coalesce(amount_collected, 0.00) AS DECIMAL(18,2))
                   AS revenue_minus_collected_variance
        FROM stg_orders
        LEFT JOIN (SELECT order_id, CAST(sum(quantity) AS BIGINT) AS q, CAST(sum(line_amount) AS DECIMAL(18,2)) AS a
                   FROM stg_order_items GROUP BY 1) USING (order_id)
        LEFT JOIN int_order_payment_summary USING (order_id)""",
    # -- billing --------------------------------------------------------------------------
    "fct_payments": """
        SELECT payment_id, invoice_id, payment_date, payment_status, payment_method, is_retry, payment_amount,
               CAST(coalesce(r, 0) AS DECIMAL(18,2)) AS refunded_amount,
               CAST(payment_amount - coalesce(r, 0) AS DECIMAL(18,2)) AS net_collected_amount
        FROM stg_billing__payments
        LEFT JOIN (SELECT payment_id, sum(refund_amount) AS r FROM stg_billing__refunds GROUP BY 1) USING (payment_id)""",
    "fct_invoices": """
        SELECT invoice_id, subscription_id, customer_id, invoice_date, invoice_amount,
               count(payment_id) AS payment_attempt_count,
               count(*) FILTER (payment_status = 'succeeded') > 0 AS has_succeeded_payment,
               count(*) FILTER (payment_status = 'failed') > 0 AS has_failed_attempt,
               CAST(coalesce(sum(net_collected_amount) FILTER (payment_status = 'succeeded'), 0) AS DECIMAL(18,2))
                   AS net_collected_amount,
               CAST(coalesce(sum(refunded_amount) FILTER (payment_status = 'succeeded'), 0) AS DECIMAL(18,2))
                   AS refunded_amount,
               max(payment_date) AS last_payment_date,
               CAST(invoice_amount - coalesce(sum(net_collected_amount) FILTER (payment_status = 'succeeded'), 0)
                    AS DECIMAL(18,2)) AS outstanding_balance
        FROM stg_billing__invoices LEFT JOIN fct_payments USING (invoice_id)
        GROUP BY invoice_id, subscription_id, customer_id, invoice_date, invoice_amount""",
    "fct_subscriptions": f"""
        SELECT subscription_id, subscription_chain_id, customer_id, plan_id, plan_name, billing_interval,
               phase_start_date, phase_end_date, phase_type, is_trial, ended_reason,
               CAST(CASE WHEN is_trial THEN 0 ELSE {_MONTHLY} END AS DECIMAL(18,2)) AS mrr_amount
        FROM stg_billing__subscriptions JOIN stg_billing__plans USING (plan_id)""",
    "dim_plans": f"""
        SELECT plan_id, plan_name, billing_interval, currency, price AS list_price,
               CAST({_MONTHLY} AS DECIMAL(18,2)) AS monthly_equivalent_price
        FROM stg_billing__plans""",
    "last_billed": "SELECT max(period_end) AS d FROM stg_billing__invoices",
    "int_subscription_active_phase_months": """
        SELECT subscription_id, subscription_chain_id, customer_id, plan_id, mrr_amount, phase_start_date,
               CAST(m AS DATE) AS activity_month
        FROM fct_subscriptions, last_billed,
             unnest(generate_series(date_trunc('month', phase_start_date),
                                    CAST(coalesce(phase_end_date, d) - 1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS t(m)""",
    "int_subscription_chain_month_spine": """
        SELECT c.subscription_chain_id, c.customer_id, CAST(m AS DATE) AS activity_month
        FROM (SELECT subscription_chain_id, customer_id, date_trunc('month', min(phase_start_date)) AS lo
              FROM fct_subscriptions GROUP BY ALL) c, last_billed,
             unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(d AS TIMESTAMP), INTERVAL 1 MONTH)) AS t(m)""",
    "int_subscription_mrr_by_chain_month": """
        SELECT s.subscription_chain_id, s.customer_id, s.activity_month, a.plan_id,
               CAST(coalesce(a.mrr_amount, 0) AS DECIMAL(18,2)) AS mrr_amount
        FROM int_subscription_chain_month_spine s
        LEFT JOIN (SELECT * FROM int_subscription_active_phase_months
                   QUALIFY row_number() OVER (PARTITION BY subscription_chain_id, activity_month
                                              ORDER BY phase_start_date DESC, subscription_id DESC) = 1) a
               ON a.subscription_chain_id = s.subscription_chain_id AND a.activity_month = s.activity_month""",
    "int_subscription_mrr_movements": """
        WITH h AS (SELECT *, coalesce(lag(mrr_amount) OVER w, 0.00) AS p,
                          coalesce(max(mrr_amount) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 AS paid
                   FROM int_subscription_mrr_by_chain_month
                   WINDOW w AS (PARTITION BY subscription_chain_id ORDER BY activity_month))
        SELECT subscription_chain_id, customer_id, activity_month, mrr_amount, CAST(p AS DECIMAL(18,2)) AS prev_mrr_amount,
               CAST(if(p = 0 AND NOT paid, mrr_amount, 0) AS DECIMAL(18,2)) AS new_mrr,
               CAST(if(p = 0 AND paid, mrr_amount, 0) AS DECIMAL(18,2)) AS reactivation_mrr,
               CAST(if(p > 0, greatest(mrr_amount - p, 0), 0) AS DECIMAL(18,2)) AS expansion_mrr,
               CAST(if(mrr_amount > 0, greatest(p - mrr_amount, 0), 0) AS DECIMAL(18,2)) AS contraction_mrr,
               CAST(if(mrr_amount = 0, p, 0) AS DECIMAL(18,2)) AS churned_mrr
        FROM h""",
    "mart_monthly_recurring_revenue": """
        SELECT activity_month, CAST(sum(mrr_amount) AS DECIMAL(18,2)) AS total_mrr,
               count(DISTINCT subscription_chain_id) FILTER (mrr_amount > 0) AS paying_subscription_count,
               count(DISTINCT customer_id) FILTER (mrr_amount > 0) AS paying_customer_count
        FROM int_subscription_mrr_by_chain_month GROUP BY 1""",
    "mrr_sums": """
        SELECT activity_month, CAST(sum(prev_mrr_amount) AS DECIMAL(18,2)) AS opening_mrr,
               CAST(sum(new_mrr) AS DECIMAL(18,2)) AS new_mrr,
               CAST(sum(expansion_mrr) AS DECIMAL(18,2)) AS expansion_mrr,
               CAST(sum(reactivation_mrr) AS DECIMAL(18,2)) AS reactivation_mrr,
               CAST(sum(contraction_mrr) AS DECIMAL(18,2)) AS contraction_mrr,
               CAST(sum(churned_mrr) AS DECIMAL(18,2)) AS churned_mrr,
               CAST(sum(mrr_amount) AS DECIMAL(18,2)) AS closing_mrr
        FROM int_subscription_mrr_movements GROUP BY 1""",
    "mart_mrr_movements": f"""
        SELECT *, CAST(opening_mrr + new_mrr + expansion_mrr + reactivation_mrr - contraction_mrr - churned_mrr
                       AS DECIMAL(18,2)) AS computed_closing_mrr,
               {exact_ratio("opening_mrr - contraction_mrr - churned_mrr", "opening_mrr")} AS gross_revenue_retention,
               {exact_ratio("opening_mrr - contraction_mrr - churned_mrr + expansion_mrr", "opening_mrr")}
                   AS net_revenue_retention
        FROM mrr_sums""",
    "cohort_months": """
        SELECT subscription_chain_id, CAST(date_trunc('month', min(phase_start_date)) AS DATE) AS cohort_month
        FROM fct_subscriptions WHERE phase_type IN ('trial', 'new') GROUP BY 1""",
    "mart_retention_cohorts": f"""
        WITH c AS (SELECT cohort_month, {_MONTHS_APART.format(a="activity_month", b="cohort_month")}
                              AS months_since_cohort_start,
                          (SELECT count(*) FROM cohort_months x WHERE x.cohort_month = m.cohort_month) AS cohort_size,
                          count(DISTINCT subscription_chain_id) FILTER (mrr_amount > 0) AS active_chain_count
                   FROM cohort_months m JOIN int_subscription_mrr_by_chain_month USING (subscription_chain_id)
                   WHERE activity_month >= cohort_month GROUP BY ALL)
        SELECT *, {exact_ratio("active_chain_count", "cohort_size")} AS retention_rate FROM c""",
    "mart_customer_lifetime_value": """
        WITH latest AS (SELECT max(activity_month) AS m FROM int_subscription_mrr_by_chain_month),
        avg_mrr AS (SELECT CAST(sum(mrr_amount) AS DOUBLE) / count(*) AS a
                    FROM int_subscription_mrr_by_chain_month, latest WHERE activity_month = m AND mrr_amount > 0),
        churn AS (SELECT avg(CAST(c AS DOUBLE) / o) AS r
                  FROM (SELECT count(DISTINCT subscription_chain_id) FILTER (churned_mrr > 0) AS c,
                               count(DISTINCT subscription_chain_id) FILTER (prev_mrr_amount > 0) AS o
                        FROM int_subscription_mrr_movements GROUP BY activity_month) WHERE o > 0)
        SELECT m AS as_of_month, CAST(round(a, 2) AS DECIMAL(18,2)) AS avg_mrr_per_active_customer,
               CAST(round(r, 4) AS DECIMAL(18,4)) AS monthly_churn_rate,
               CAST(round(a / nullif(r, 0), 2) AS DECIMAL(18,2)) AS estimated_clv
        FROM latest, avg_mrr, churn""",
    "mart_customer_metrics": f"""
        WITH s AS (SELECT customer_id, min(phase_start_date) AS first_subscription_date,
                          count(*) > count(phase_end_date) AS is_currently_active
                   FROM fct_subscriptions GROUP BY 1),
        i AS (SELECT customer_id, sum(invoice_amount) AS a, sum(net_collected_amount) AS c, sum(refunded_amount) AS r
              FROM fct_invoices GROUP BY 1)
        SELECT customer_id, first_subscription_date, is_currently_active,
               {_MONTHS_APART.format(a="d", b="first_subscription_date")} AS tenure_months,
               {_money("coalesce(a, 0)")} AS lifetime_invoiced_amount,
               {_money("coalesce(c, 0)")} AS lifetime_collected_amount,
               {_money("coalesce(r, 0)")} AS lifetime_refunded_amount
        FROM s LEFT JOIN i USING (customer_id), last_billed""",
    "mart_invoice_reconciliation": """
        SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS activity_month, count(*) AS invoice_count,
               CAST(sum(invoice_amount) AS DECIMAL(18,2)) AS invoiced_amount,
               CAST(sum(net_collected_amount) AS DECIMAL(18,2)) AS collected_amount,
               CAST(sum(refunded_amount) AS DECIMAL(18,2)) AS refunded_amount,
               CAST(sum(outstanding_balance) AS DECIMAL(18,2)) AS outstanding_amount
        FROM fct_invoices GROUP BY 1""",
    # -- events ---------------------------------------------------------------------------
    "int_identity_resolution": """
        SELECT anonymous_id, max(customer_id) AS resolved_customer_id FROM stg_events__events GROUP BY 1""",
    "int_events_resolved": """
        SELECT event_id, anonymous_id, max(customer_id) OVER (PARTITION BY anonymous_id) AS resolved_customer_id,
               event_type, event_timestamp, product_id, order_id, search_query FROM stg_events__events""",
    "int_events_deduplicated": f"""
        SELECT * FROM int_events_resolved
        WHERE event_id IN (SELECT min(event_id) FROM int_events_resolved GROUP BY {_KEY})""",
    **{
        name: f"""
        WITH g AS (SELECT *, coalesce(event_timestamp - lag(event_timestamp) OVER w > INTERVAL '{minutes} minutes', true) AS b
                   FROM int_events_deduplicated
                   WINDOW w AS (PARTITION BY anonymous_id ORDER BY event_timestamp, event_id))
        SELECT * EXCLUDE (b), anonymous_id || '_' || sum(CAST(b AS INTEGER)) OVER (
                   PARTITION BY anonymous_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS session_id
        FROM g"""
        for name, minutes in (("int_sessions", 30), ("int_sessions_12h", 720))
    },
    "fct_events": """
        SELECT event_id, anonymous_id, resolved_customer_id AS customer_id, session_id, event_type, event_timestamp,
               product_id, order_id, search_query FROM int_sessions""",
    **{
        name: f"""
        SELECT session_id, anonymous_id, resolved_customer_id AS customer_id, min(event_timestamp) AS session_start,
               max(event_timestamp) AS session_end, count(*) AS event_count,
               count(*) FILTER (event_type = 'purchase') > 0 AS converted
        FROM {source} GROUP BY ALL"""
        for name, source in (("fct_sessions", "int_sessions"), ("fct_sessions_12h", "int_sessions_12h"))
    },
    "funnel_counts": """
        WITH v AS (SELECT CAST(event_timestamp AS DATE) AS activity_date, event_type,
                          coalesce(CAST(resolved_customer_id AS VARCHAR), anonymous_id) AS who FROM int_sessions)
        SELECT activity_date, count(DISTINCT who) FILTER (event_type = 'product_view') AS viewers,
               count(DISTINCT who) FILTER (event_type = 'add_to_cart') AS carters,
               count(DISTINCT who) FILTER (event_type = 'checkout_start') AS checkout_starters,
               count(DISTINCT who) FILTER (event_type = 'purchase') AS purchasers
        FROM v GROUP BY 1""",
    "mart_funnel_conversion": f"""
        SELECT *, {exact_ratio("carters", "viewers")} AS view_to_cart_rate,
               {exact_ratio("checkout_starters", "carters")} AS cart_to_checkout_rate,
               {exact_ratio("purchasers", "checkout_starters")} AS checkout_to_purchase_rate,
               {exact_ratio("purchasers", "viewers")} AS view_to_purchase_rate
        FROM funnel_counts""",
    "mart_activation": """
        WITH s AS (SELECT resolved_customer_id AS c, min(event_timestamp) AS t FROM int_sessions
                   WHERE event_type = 'signup' AND resolved_customer_id IS NOT NULL GROUP BY 1)
        SELECT c AS customer_id, t AS first_signup_at, min(event_timestamp) AS first_purchase_at,
               (epoch_us(min(event_timestamp)) - epoch_us(t)) / 86400000000.0::DOUBLE AS days_to_first_purchase,
               coalesce(min(event_timestamp) <= t + INTERVAL 14 DAY, false) AS is_activated
        FROM s LEFT JOIN int_sessions e
          ON e.resolved_customer_id = c AND event_type = 'purchase' AND event_timestamp >= t
        GROUP BY c, t""",
    # -- finance --------------------------------------------------------------------------
    "dim_accounting_periods": "SELECT *, closed_at IS NOT NULL AS is_closed FROM accounting_periods",
    "int_revenue_by_period_retail": """
        SELECT order_id, customer_id, order_date, period_id, order_amount AS booked_revenue,
               amount_collected AS collected_amount,
               CAST(round(order_amount * coalesce(tax_rate, 0.0000), 2) AS DECIMAL(18,2)) AS tax_amount
        FROM fct_orders JOIN stg_customers USING (customer_id) LEFT JOIN tax_rates USING (region)
        JOIN accounting_periods ON order_date BETWEEN period_start_date AND period_end_date
        WHERE order_status = 'completed'""",
    "int_revenue_by_period_billing": """
        SELECT invoice_id, customer_id, invoice_date, period_id, invoice_amount AS booked_revenue,
               net_collected_amount AS collected_amount, refunded_amount AS refunded_amount_against_bookings,
               CAST(round(invoice_amount * coalesce(tax_rate, 0.0000), 2) AS DECIMAL(18,2)) AS tax_amount
        FROM fct_invoices JOIN stg_customers USING (customer_id) LEFT JOIN tax_rates USING (region)
        JOIN accounting_periods ON invoice_date BETWEEN period_start_date AND period_end_date""",
    "int_cash_movements_retail": """
        SELECT period_id,
               CAST(coalesce(sum(amount) FILTER (payment_status <> 'failed'), 0) AS DECIMAL(18,2)) AS cash_in,
               CAST(coalesce(sum(amount) FILTER (payment_status = 'refunded'), 0) AS DECIMAL(18,2)) AS cash_out
        FROM stg_payments JOIN accounting_periods ON payment_date BETWEEN period_start_date AND period_end_date
        GROUP BY 1""",
    "int_cash_movements_billing": """
        WITH moved AS (SELECT payment_date AS d, CASE WHEN payment_status = 'succeeded' THEN payment_amount ELSE 0 END AS i,
                              0 AS o FROM stg_billing__payments
                       UNION ALL SELECT refund_date, 0, refund_amount FROM stg_billing__refunds)
        SELECT period_id, CAST(sum(i) AS DECIMAL(18,2)) AS cash_in, CAST(sum(o) AS DECIMAL(18,2)) AS cash_out
        FROM moved JOIN accounting_periods ON d BETWEEN period_start_date AND period_end_date GROUP BY 1""",
    "fct_period_close_adjustments": """
        SELECT refund_id, i.invoice_id, invoice_date, refund_date, refund_amount, o.period_id AS original_period_id,
               a.period_id AS adjustment_period_id, o.closed_at AS original_period_closed_at,
               coalesce(refund_date > o.closed_at, false) AS is_late_adjustment,
               CASE WHEN refund_date > o.closed_at THEN CAST(refund_date - o.closed_at AS INTEGER) END AS days_after_close
        FROM stg_billing__refunds r JOIN stg_billing__payments p USING (payment_id)
        JOIN stg_billing__invoices i ON i.invoice_id = p.invoice_id
        JOIN accounting_periods o ON invoice_date BETWEEN o.period_start_date AND o.period_end_date
        JOIN accounting_periods a ON refund_date BETWEEN a.period_start_date AND a.period_end_date""",
    "phase_periods": """
        SELECT subscription_id, customer_id, period_id, period_start_date
        FROM fct_subscriptions JOIN accounting_periods
          ON phase_start_date <= period_end_date AND coalesce(phase_end_date >= period_start_date, true)""",
    "int_active_customers_by_period": """
        SELECT period_id, customer_id, period_start_date FROM stg_orders
        JOIN accounting_periods ON order_date BETWEEN period_start_date AND period_end_date
        WHERE order_status = 'completed'
        UNION
        SELECT period_id, customer_id, period_start_date FROM phase_periods""",
    "mart_revenue_reconciliation_by_period": """
        WITH r AS (SELECT period_id, sum(booked_revenue) AS b, sum(collected_amount) AS c, sum(tax_amount) AS t
                   FROM int_revenue_by_period_retail GROUP BY 1),
        s AS (SELECT period_id, sum(booked_revenue) AS b, sum(collected_amount) AS c,
                     sum(refunded_amount_against_bookings) AS f, sum(tax_amount) AS t
              FROM int_revenue_by_period_billing GROUP BY 1),
        j AS (SELECT p.*, coalesce(r.b, 0) AS rb, coalesce(s.b, 0) AS sb, coalesce(r.c, 0) AS rc, coalesce(s.c, 0) AS sc,
                     coalesce(f, 0) AS sf, coalesce(r.t, 0) + coalesce(s.t, 0) AS tax
              FROM dim_accounting_periods p LEFT JOIN r USING (period_id) LEFT JOIN s USING (period_id))
        SELECT period_id, period_start_date, period_end_date, is_closed,
               CAST(rb AS DECIMAL(18,2)) AS retail_net_booked_revenue, CAST(sb AS DECIMAL(18,2)) AS billing_net_booked_revenue,
               CAST(rc AS DECIMAL(18,2)) AS retail_collected_against_bookings,
               CAST(sc AS DECIMAL(18,2)) AS billing_collected_against_bookings,
               CAST(sf AS DECIMAL(18,2)) AS billing_refunded_amount_against_bookings,
               CAST(rb + sb AS DECIMAL(18,2)) AS total_net_booked_revenue, CAST(tax AS DECIMAL(18,2)) AS total_tax_amount,
               CAST(rc + sc AS DECIMAL(18,2)) AS total_collected_against_bookings,
               CAST(rb + sb - rc - sc AS DECIMAL(18,2)) AS variance
        FROM j""",
    "mart_cash_movements_by_period": """
        WITH j AS (SELECT p.*, coalesce(r.cash_in, 0) AS ri, coalesce(r.cash_out, 0) AS ro,
                          coalesce(b.cash_in, 0) AS bi, coalesce(b.cash_out, 0) AS bo
                   FROM dim_accounting_periods p LEFT JOIN int_cash_movements_retail r USING (period_id)
                   LEFT JOIN int_cash_movements_billing b USING (period_id))
        SELECT period_id, period_start_date, period_end_date, is_closed,
               CAST(ri AS DECIMAL(18,2)) AS retail_cash_in, CAST(ro AS DECIMAL(18,2)) AS retail_cash_out,
               CAST(bi AS DECIMAL(18,2)) AS billing_cash_in, CAST(bo AS DECIMAL(18,2)) AS billing_cash_out,
               CAST(ri - ro AS DECIMAL(18,2)) AS retail_net_cash_movement,
               CAST(bi - bo AS DECIMAL(18,2)) AS billing_net_cash_movement,
               CAST(ri + bi AS DECIMAL(18,2)) AS total_cash_in, CAST(ro + bo AS DECIMAL(18,2)) AS total_cash_out,
               CAST(ri + bi - ro - bo AS DECIMAL(18,2)) AS total_net_cash_movement
        FROM j""",
    # -- reliability ----------------------------------------------------------------------
    "int_volume_by_period": """
        WITH d AS (SELECT 'orders' AS source_name, order_date AS d FROM fct_orders
                   UNION ALL SELECT 'invoices', invoice_date FROM fct_invoices
                   UNION ALL SELECT 'events', CAST(event_timestamp AS DATE) FROM int_events_deduplicated)
        SELECT period_id, source_name, count(*) AS row_count
        FROM d JOIN accounting_periods ON d BETWEEN period_start_date AND period_end_date GROUP BY ALL""",
    **{
        name: f"""
        SELECT b.source_name, p.period_id, coalesce(row_count, 0) AS row_count
        FROM (SELECT source_name, min(period_id) AS lo, {last} AS hi FROM int_volume_by_period GROUP BY 1) b
        JOIN accounting_periods p ON p.period_id BETWEEN lo AND hi
        LEFT JOIN int_volume_by_period v ON v.source_name = b.source_name AND v.period_id = p.period_id"""
        for name, last in (
            ("volume_filled", "max(period_id)"),
            ("volume_filled_latest", "(SELECT max(period_id) FROM int_volume_by_period)"),
        )
    },
    "int_volume_anomaly_by_period": f"""
        WITH t AS (SELECT *, sum(row_count) OVER w AS s, count(row_count) OVER w AS n FROM volume_filled
                   WINDOW w AS (PARTITION BY source_name ORDER BY period_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
        SELECT source_name, period_id, period_start_date, is_closed, row_count,
               {exact_ratio("s", "n", 1)} AS trailing_avg_row_count,
               {exact_ratio("row_count * n - s", "s", 1, factor=100)} AS pct_change_vs_trailing_avg
        FROM t JOIN dim_accounting_periods USING (period_id)""",
    "mart_volume_anomalies": """
        SELECT *, trailing_avg_row_count >= 10 AS is_eligible_for_check,
               is_closed AND trailing_avg_row_count >= 10 AND pct_change_vs_trailing_avg <= -40 AS is_anomaly
        FROM int_volume_anomaly_by_period""",
}

# Names that are the same relation.
VIEWS["int_order_items_enriched"] = "SELECT * FROM fct_order_items"
VIEWS["int_payment_refund_netting"] = "SELECT * FROM fct_payments"
VIEWS["int_invoice_payment_status"] = "SELECT * FROM fct_invoices"
VIEWS["int_subscription_periods"] = "SELECT * FROM fct_subscriptions"
VIEWS["int_period_close_adjustments"] = "SELECT * FROM fct_period_close_adjustments"


def _mentions(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(re.findall(r"[a-z_0-9]+", sql)) if w in VIEWS]


def with_views(sql: str) -> str:
    """``sql`` preceded by the common table expressions it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for other in _mentions(VIEWS[name]):
                if other != name:
                    add(other)
            ordered.append(name)

    for name in _mentions(sql):
        add(name)
    if not ordered:
        return sql
    shared = "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in ordered)
    body = sql.strip()
    return f"{shared},\n{body[4:].lstrip()}" if body.startswith("WITH") else f"{shared}\n{body}"
