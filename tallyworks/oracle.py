"""DuckDB SQL for the registered queries, written apart from the DataFrame code."""

from __future__ import annotations

import re

from tallyworks.operators.checks import RowCheck, Unique
from tallyworks.oracle_views import VIEWS, exact_ratio, with_views
from tallyworks.plans.checkbook import generic_checks
from tallyworks.plans.faults import FAULTS, LOST, NEGATIVE_PAYMENTS, Fault, Lost
from tallyworks.plans.warehouse import CONTRACTS
from tallyworks.queries import MODEL_IDS, STAGING_IDS
from tallyworks.sources.ingest import SOURCES

MONTH_OF = "CAST(date_trunc('month', {0}) AS DATE)"


def _sum(expr: str) -> str:
    return f"CAST(sum({expr}) AS DECIMAL(18,2))"


def _check_count(check) -> str:
    """Number of failing rows of one declared check, as SQL."""
    t = check.table
    if isinstance(check, Unique):
        cols = ", ".join(check.columns)
        known = f"WHERE {cols} IS NOT NULL" if len(check.columns) == 1 else ""
        return f"SELECT count(*) FROM (SELECT {cols} FROM {t} {known} GROUP BY {cols} HAVING count(*) > 1)"
    c = check.column
    if isinstance(check, RowCheck):
        condition = {
            "not_null": lambda: f"{c} IS NULL",
            "not_negative": lambda: f"{c} < 0",
            "not_implausibly_large": lambda: f"{c} > {check.max_value}",
            "accepted_range": lambda: " OR ".join(
                [f"{c} < {check.min_value}"] * (check.min_value is not None) + [f"{c} > {check.max_value}"] * (check.max_value is not None)
            ),
            "accepted_values": lambda: f"{c} NOT IN {check.values}",
        }[check.kind]()
        return f"SELECT count(*) FROM {t} WHERE {condition}"
    return (
        f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL "
        f"AND {c} NOT IN (SELECT {check.parent_column} FROM {check.parent})"
    )


def _check_results() -> str:
    rows = [
        f"SELECT '{c.name}' AS \"check\", '{c.table}' AS \"table\", ({_check_count(c)}) AS failing_rows"
        for c in generic_checks()
    ]
    for name, sql in SQL.items():
        if name.startswith("sgl") and "_fault_" not in name:
            check = name.split("_", 1)[1]
            rows.append(f"SELECT '{check}', '{check}', (SELECT count(*) FROM ({sql}) AS found)")
    return (
        'SELECT "check", "table", CASE WHEN failing_rows = 0 THEN \'pass\' ELSE \'fail\' END AS status, '
        f"failing_rows FROM ({' UNION ALL '.join(rows)}) AS counted"
    )


_LATE = """SELECT refund_id, original_period_id, adjustment_period_id, days_after_close
           FROM fct_period_close_adjustments WHERE is_late_adjustment"""
_CLOSED = "FROM mart_revenue_reconciliation_by_period WHERE is_closed"
_LOADS = ", ".join(
    f"('{name}', {9 * i})" for i, name in enumerate(f"{s}.{t}" for s, tables in SOURCES.items() for t in tables)
)
_FRESHNESS = f"""
    SELECT source_name, CAST((SELECT max(order_date) FROM stg_orders) + 2 AS TIMESTAMP) - h * INTERVAL 1 HOUR AS max_loaded_at,
           CASE WHEN h > 72 THEN 'error' WHEN h > 24 THEN 'warn' ELSE 'pass' END AS status
    FROM (VALUES {_LOADS}) AS loads(source_name, h)"""
_KEPT = "opening_mrr - contraction_mrr - churned_mrr"


def _money_ratio(num: str, den: str) -> str:
    return exact_ratio(num, den, digits=10, width=38)


def _count_ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} END"


SQL: dict[str, str] = {
    "src2_coerce_temporal": """
        SELECT o_orderkey, o_orderdate AS order_time, CAST(o_orderdate AS DATE) AS order_day, o_orderpriority FROM orders""",
    "src3_stamp_loaded_at": """
        SELECT o_orderkey AS order_id, TIMESTAMP '2001-09-01 06:00:00' AS loaded_at FROM orders""",
    "src7_accounting_periods": "SELECT * FROM accounting_periods",
    "src8_tax_rates": "SELECT * FROM tax_rates",
    "flt1_completed_orders": "SELECT * FROM stg_orders WHERE order_status = 'completed'",
    "flt2_first_phases": """
        SELECT subscription_id, phase_type, phase_start_date FROM fct_subscriptions WHERE phase_type IN ('trial', 'new')""",
    "flt3_identified_events": """
        SELECT event_id, anonymous_id, customer_id FROM stg_events__events WHERE customer_id IS NOT NULL""",
    "flt4_authoritative_phase": """
        SELECT a.* FROM int_subscription_active_phase_months a
        JOIN (SELECT subscription_chain_id, activity_month, max((phase_start_date, subscription_id)) AS best
              FROM int_subscription_active_phase_months GROUP BY ALL) b
          ON a.subscription_chain_id = b.subscription_chain_id AND a.activity_month = b.activity_month
         AND (a.phase_start_date, a.subscription_id) = b.best""",
    "flt5_frequent_buyers": """
        SELECT customer_id, count(*) AS order_count FROM stg_orders WHERE order_status = 'completed'
        GROUP BY 1 HAVING count(*) > 4""",
    "flt7_late_adjustments": "SELECT * FROM fct_period_close_adjustments WHERE is_late_adjustment",
    "flt8_orders_without_items": """
        SELECT order_id, order_status FROM stg_orders WHERE order_id NOT IN (SELECT order_id FROM stg_order_items)""",
    "jn3_tax_by_region": """
        SELECT order_id, region, order_amount,
               CAST(round(order_amount * coalesce(tax_rate, 0.0000), 2) AS DECIMAL(18,2)) AS tax_amount
        FROM fct_orders JOIN stg_customers USING (customer_id) LEFT JOIN tax_rates USING (region)""",
    "jn6_payment_periods": """
        SELECT payment_id, payment_date, amount, period_id FROM stg_payments
        JOIN accounting_periods ON payment_date BETWEEN period_start_date AND period_end_date""",
    "jn8_phase_periods": "SELECT * FROM phase_periods",
    "jn14_latest_month_rows": """
        SELECT * FROM int_subscription_mrr_by_chain_month
        WHERE activity_month = (SELECT max(activity_month) FROM int_subscription_mrr_by_chain_month)""",
    "sc16_months_since_signup": """
        SELECT order_id, CAST((year(order_date) - year(signup_date)) * 12 + month(order_date) - month(signup_date)
                              AS INTEGER) AS months_since_signup
        FROM stg_orders JOIN stg_customers USING (customer_id)""",
    "sg4_zero_fill": "SELECT * FROM volume_filled",
    "sg4_zero_fill_latest": "SELECT * FROM volume_filled_latest",
    "wn9_next_phase_start": """
        SELECT subscription_id, subscription_chain_id, phase_start_date,
               lead(phase_start_date) OVER (PARTITION BY subscription_chain_id ORDER BY phase_start_date, subscription_id)
                   AS next_phase_start_date
        FROM fct_subscriptions""",
    "wn4_sessions_12h": "SELECT * FROM int_sessions_12h",
    "ag3_session_totals_12h": "SELECT * FROM fct_sessions_12h",
    "hx1_scd2_customers": """
        WITH was AS (SELECT customer_id, first_name, last_name, email, region, country FROM raw_customers),
        now AS (SELECT customer_id, if(customer_id % 5 = 0, 'Renamed', first_name) AS first_name, last_name,
                       if(customer_id % 7 = 0, 'new.' || email, email) AS email,
                       if(customer_id % 11 = 0, 'MOVED', region) AS region, country FROM was),
        changed AS (SELECT customer_id FROM was WHERE customer_id % 13 <> 0 AND (customer_id % 7 = 0 OR customer_id % 11 = 0))
        SELECT *, TIMESTAMP '2001-09-01' AS valid_from,
               CASE WHEN customer_id IN (FROM changed) THEN TIMESTAMP '2001-09-02' END AS valid_to FROM was
        UNION ALL
        SELECT *, TIMESTAMP '2001-09-02', NULL FROM now WHERE customer_id IN (FROM changed)
        UNION ALL
        SELECT * REPLACE (customer_id + 1000000000000 AS customer_id), TIMESTAMP '2001-09-02', NULL
        FROM now WHERE customer_id % 17 = 0""",
    "chk1_unique": """
        SELECT order_id, count(*) AS n_records FROM stg_order_items GROUP BY 1 HAVING count(*) > 1""",
    "chk2_not_null": """
        SELECT event_id, anonymous_id FROM int_events_resolved WHERE resolved_customer_id IS NULL""",
    "chk3_accepted_values": """
        SELECT ended_reason AS value, count(*) AS n_records FROM stg_billing__subscriptions
        WHERE ended_reason NOT IN ('cancelled', 'paused') GROUP BY 1""",
    "chk4_relationships": """
        SELECT order_id AS orphan_key, count(*) AS n_records FROM stg_orders
        WHERE order_id NOT IN (SELECT order_id FROM stg_order_items) GROUP BY 1""",
    "chk5_accepted_range": """
        SELECT cohort_month, months_since_cohort_start, retention_rate FROM mart_retention_cohorts
        WHERE retention_rate <= 0 OR retention_rate >= 1""",
    "chk6_not_negative": """
        SELECT payment_id, net_collected_amount FROM fct_payments WHERE net_collected_amount < 0""",
    "chk7_not_implausibly_large": "SELECT order_id, order_amount FROM fct_orders WHERE order_amount > 10000",
    "chk8_unique_combination": """
        SELECT customer_id, order_date, count(*) AS n_records FROM stg_orders GROUP BY 1, 2 HAVING count(*) > 1""",
    "chk9_contract": "SELECT * FROM mart_cash_movements_by_period",
    "chk10_freshness": _FRESHNESS,
    "chk12_volume_anomaly": "SELECT * FROM mart_volume_anomalies WHERE is_anomaly",
    "chk14_reconcile": """
        SELECT period_id, 'amount' AS column_name, CAST(total_collected_against_bookings AS DECIMAL(28,2)) AS left_value,
               CAST(total_cash_in AS DECIMAL(28,2)) AS right_value
        FROM mart_revenue_reconciliation_by_period JOIN mart_cash_movements_by_period USING (period_id)
        WHERE total_collected_against_bookings <> total_cash_in""",
    "chk15_late_adjustments": _LATE,
    "chk16_check_grew": """
        SELECT count(*) FILTER (is_late_adjustment) AS before_count, count(*) AS after_count,
               count(*) > count(*) FILTER (is_late_adjustment) AS grew FROM fct_period_close_adjustments""",
    "sem5_simple_metric": """
        SELECT activity_month AS metric_time__month, closing_mrr AS mrr, opening_mrr, expansion_mrr FROM mart_mrr_movements""",
    "sem6_filtered_metric": f"""
        WITH g AS (SELECT region, count(*) AS signups, nullif(count(*) FILTER (is_activated), 0) AS activated_customers
                   FROM mart_activation JOIN dim_customers USING (customer_id) GROUP BY 1)
        SELECT region AS customer_id__region, signups, activated_customers,
               {_count_ratio("activated_customers", "signups")} AS activation_rate FROM g""",
    "sem6_filtered_metric_alone": f"""
        SELECT {MONTH_OF.format("first_signup_at")} AS metric_time__month, count(*) AS activated_customers
        FROM mart_activation WHERE is_activated GROUP BY 1""",
    "sem7_derived_metrics": f"""
        SELECT activity_month AS metric_time__month, CAST(closing_mrr * 12 AS DECIMAL(20,2)) AS arr,
               {_money_ratio("churned_mrr", "opening_mrr")} AS churn_rate,
               {_money_ratio(_KEPT, "opening_mrr")} AS gross_revenue_retention,
               {_money_ratio(_KEPT + " + expansion_mrr", "opening_mrr")} AS net_revenue_retention
        FROM mart_mrr_movements""",
    "sem8_rolled_up_time": f"""
        WITH g AS (SELECT {MONTH_OF.format("activity_date")} AS metric_time__month, CAST(sum(viewers) AS BIGINT) AS viewers,
                          CAST(sum(purchasers) AS BIGINT) AS purchasers FROM mart_funnel_conversion GROUP BY 1)
        SELECT *, {_count_ratio("purchasers", "viewers")} AS view_to_purchase_rate FROM g""",
    "sem9_own_dimension": f"""
        SELECT order_channel AS order_id__order_channel, order_status AS order_id__order_status,
               {_sum("order_amount")} AS order_revenue, {_sum("amount_collected")} AS order_amount_collected
        FROM fct_orders GROUP BY 1, 2""",
    "sem10_joined_dimension": f"""
        SELECT country AS customer_id__country, CAST(date_trunc('year', order_date) AS DATE) AS metric_time__year,
               {_sum("order_amount")} AS order_revenue
        FROM fct_orders LEFT JOIN dim_customers USING (customer_id) GROUP BY 1, 2""",
    "sem10_joined_distinct": """
        SELECT region AS customer_id__region, period_start_date AS metric_time__month,
               count(DISTINCT customer_id) AS active_customers
        FROM int_active_customers_by_period LEFT JOIN dim_customers USING (customer_id) GROUP BY 1, 2""",
    "sem11_where": f"""
        SELECT order_channel AS order_id__order_channel, {_sum("order_amount")} AS order_revenue
        FROM fct_orders JOIN dim_customers USING (customer_id)
        WHERE order_status = 'completed' AND country <> 'ASIA' GROUP BY 1""",
    "sem12_several_models": f"""
        WITH months AS (SELECT period_start_date AS m FROM accounting_periods UNION SELECT activity_month FROM mart_mrr_movements
                        UNION SELECT {MONTH_OF.format("order_date")} FROM fct_orders)
        SELECT m AS metric_time__month, total_net_booked_revenue AS net_booked_revenue, total_cash_in AS cash_in,
               n AS active_customers, closing_mrr AS mrr, s AS order_revenue
        FROM months LEFT JOIN mart_revenue_reconciliation_by_period r ON r.period_start_date = m
        LEFT JOIN mart_cash_movements_by_period c ON c.period_start_date = m
        LEFT JOIN (SELECT period_start_date AS am, count(*) AS n FROM int_active_customers_by_period GROUP BY 1) ON am = m
        LEFT JOIN mart_mrr_movements ON activity_month = m
        LEFT JOIN (SELECT {MONTH_OF.format("order_date")} AS om, {_sum("order_amount")} AS s FROM fct_orders GROUP BY 1)
               ON om = m""",
    "sem12_shared_period": f"""
        SELECT is_closed AS period_id__is_closed, {_sum("variance")} AS booking_variance,
               {_sum("total_net_cash_movement")} AS net_cash_movement
        FROM mart_revenue_reconciliation_by_period
        JOIN (SELECT period_id, total_net_cash_movement FROM mart_cash_movements_by_period) USING (period_id) GROUP BY 1""",
    "sem13_totals": f"""
        SELECT (SELECT {_sum("total_net_booked_revenue")} FROM mart_revenue_reconciliation_by_period) AS net_booked_revenue,
               (SELECT {_sum("total_cash_out")} FROM mart_cash_movements_by_period) AS cash_out,
               (SELECT count(*) FROM mart_activation) AS signups,
               (SELECT CAST(sum(cohort_size) AS BIGINT) FROM mart_retention_cohorts) AS cohort_size""",
    "sem17_reconciliation": """
        SELECT metric, n AS keys_compared, CAST(0 AS BIGINT) AS mismatches FROM (
            SELECT unnest(['net_booked_revenue', 'cash_collected_against_bookings', 'cash_in', 'cash_out']) AS metric,
                   count(*) AS n FROM accounting_periods
            UNION ALL SELECT 'mrr', count(*) FROM mart_mrr_movements
            UNION ALL SELECT 'active_customers', count(DISTINCT period_id) FROM int_active_customers_by_period
            UNION ALL SELECT 'viewers,purchasers', count(*) FROM mart_funnel_conversion) AS compared""",
    "bi1_scorecard": f"""
        WITH c AS (SELECT period_start_date AS m, total_net_booked_revenue AS b, total_collected_against_bookings AS k
                   {_CLOSED} ORDER BY 1 DESC LIMIT 1),
        a AS (SELECT period_start_date AS m, count(*) AS n FROM int_active_customers_by_period GROUP BY 1),
        r AS (SELECT * FROM mart_mrr_movements ORDER BY activity_month DESC LIMIT 1),
        t AS (SELECT CAST(sum(active_chain_count) AS BIGINT) AS x, CAST(sum(cohort_size) AS BIGINT) AS y
              FROM mart_retention_cohorts WHERE months_since_cohort_start = 1)
        SELECT c.m AS as_of_month, b AS net_booked_revenue, k AS cash_collected_against_bookings,
               coalesce((SELECT n FROM a WHERE a.m = c.m), (SELECT n FROM a ORDER BY a.m DESC LIMIT 1)) AS active_customers,
               activity_month AS mrr_month, closing_mrr AS mrr, {exact_ratio("churned_mrr", "opening_mrr")} AS churn_rate,
               {_count_ratio("x", "y")} AS month_1_retention
        FROM c, r, t""",
    "bi2_booked_revenue_trend": f"""
        SELECT period_start_date AS metric_time__month, total_net_booked_revenue AS net_booked_revenue
        {_CLOSED} ORDER BY 1 DESC LIMIT 18""",
    "bi3_mrr_trend": """
        SELECT * FROM (SELECT activity_month AS metric_time__month, closing_mrr AS mrr FROM mart_mrr_movements
                       ORDER BY 1 DESC LIMIT 18) AS newest WHERE mrr > 0""",
    "bi4_revenue_by_channel": f"""
        SELECT order_channel AS order_id__order_channel, {_sum("order_amount")} AS order_revenue
        FROM fct_orders WHERE order_status = 'completed' GROUP BY 1""",
    "bi5_top_regions": """
        SELECT region AS customer_id__region, count(DISTINCT customer_id) AS active_customers
        FROM int_active_customers_by_period LEFT JOIN dim_customers USING (customer_id)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "bi6_funnel_totals": """
        SELECT CAST(sum(viewers) AS BIGINT) AS viewers, CAST(sum(carters) AS BIGINT) AS carters,
               CAST(sum(checkout_starters) AS BIGINT) AS checkout_starters, CAST(sum(purchasers) AS BIGINT) AS purchasers
        FROM mart_funnel_conversion""",
    "bi7_retention_curve": f"""
        WITH g AS (SELECT months_since_cohort_start AS n, CAST(sum(active_chain_count) AS BIGINT) AS a,
                          CAST(sum(cohort_size) AS BIGINT) AS s FROM mart_retention_cohorts GROUP BY 1)
        SELECT n AS retention_cohort__months_since_cohort_start, {_count_ratio("a", "s")} AS retention_rate FROM g""",
    # -- hand-written checks: the offending rows, looked for another way ----------------------
    "sgl01_assert_accounting_periods_no_gaps_or_overlaps": """
        SELECT a.period_id, a.period_end_date, b.period_start_date AS next_period_start_date
        FROM accounting_periods a JOIN accounting_periods b ON b.period_id = a.period_id + 1
        WHERE b.period_start_date <> a.period_end_date + 1""",
    "sgl02_assert_activation_purchase_not_before_signup": """
        SELECT customer_id, first_signup_at, first_purchase_at FROM mart_activation
        WHERE first_purchase_at < first_signup_at""",
    "sgl03_assert_annual_plans_normalize_to_monthly_mrr": """
        SELECT subscription_id, mrr_amount, monthly_equivalent_price AS expected_mrr_amount
        FROM fct_subscriptions JOIN dim_plans USING (plan_id)
        WHERE fct_subscriptions.billing_interval = 'annual' AND NOT is_trial AND mrr_amount <> monthly_equivalent_price""",
    "sgl04_assert_anonymous_id_maps_to_at_most_one_customer": """
        SELECT anonymous_id, count(DISTINCT customer_id) AS distinct_customer_count FROM stg_events__events
        GROUP BY 1 HAVING min(customer_id) < max(customer_id)""",
    "sgl05_assert_cash_movements_match_source_facts": """
        WITH moved AS (SELECT payment_date AS d, if(payment_status <> 'failed', amount, 0) AS i,
                              if(payment_status = 'refunded', amount, 0) AS o FROM stg_payments
                       UNION ALL SELECT payment_date, if(payment_status = 'succeeded', payment_amount, 0), 0
                                 FROM stg_billing__payments
                       UNION ALL SELECT refund_date, 0, refund_amount FROM stg_billing__refunds),
        again AS (SELECT period_id, CAST(sum(i) AS DECIMAL(18,2)) AS recomputed_total_cash_in,
                         CAST(sum(o) AS DECIMAL(18,2)) AS recomputed_total_cash_out
                  FROM moved JOIN accounting_periods ON d BETWEEN period_start_date AND period_end_date GROUP BY 1)
        SELECT period_id, total_cash_in, recomputed_total_cash_in, total_cash_out, recomputed_total_cash_out
        FROM (SELECT p.period_id, total_cash_in, total_cash_out,
                     CAST(coalesce(recomputed_total_cash_in, 0) AS DECIMAL(18,2)) AS recomputed_total_cash_in,
                     CAST(coalesce(recomputed_total_cash_out, 0) AS DECIMAL(18,2)) AS recomputed_total_cash_out
              FROM mart_cash_movements_by_period p LEFT JOIN again USING (period_id)) AS every_period
        WHERE total_cash_in <> recomputed_total_cash_in OR total_cash_out <> recomputed_total_cash_out""",
    "sgl06_assert_days_after_close_consistent_with_late_flag": """
        SELECT refund_id, is_late_adjustment, days_after_close FROM fct_period_close_adjustments
        WHERE CASE WHEN is_late_adjustment THEN coalesce(days_after_close <= 0, true) ELSE days_after_close IS NOT NULL END""",
    "sgl07_assert_invoice_lines_reconcile_to_invoice_amount": """
        SELECT invoice_id, invoice_amount, CAST(sum(line_amount) AS DECIMAL(18,2)) AS line_total
        FROM stg_billing__invoices JOIN stg_billing__invoice_lines USING (invoice_id)
        GROUP BY 1, 2 HAVING sum(line_amount) <> invoice_amount""",
    "sgl08_assert_late_adjustment_scenario_exists": """
        SELECT count(*) AS late_adjustment_count FROM fct_period_close_adjustments
        WHERE is_late_adjustment HAVING count(*) = 0""",
    "sgl09_assert_late_refund_lands_in_its_own_cash_period": """
        WITH late AS (SELECT refund_id, adjustment_period_id, refund_amount FROM fct_period_close_adjustments
                      WHERE is_late_adjustment),
        expected AS (SELECT * FROM late UNION ALL SELECT NULL, NULL, NULL WHERE (SELECT count(*) FROM late) = 0),
        paid AS (SELECT refund_id, period_id AS paid_in FROM stg_billing__refunds
                 JOIN accounting_periods ON refund_date BETWEEN period_start_date AND period_end_date)
        SELECT refund_id, adjustment_period_id, refund_amount, billing_cash_out
        FROM expected LEFT JOIN paid USING (refund_id)
        LEFT JOIN mart_cash_movements_by_period ON period_id = adjustment_period_id
        WHERE paid_in IS NULL OR paid_in <> adjustment_period_id OR billing_cash_out IS NULL OR billing_cash_out < refund_amount""",
    "sgl10_assert_mrr_bridge_reconciles": "SELECT * FROM mart_mrr_movements WHERE closing_mrr <> computed_closing_mrr",
    "sgl11_assert_no_duplicate_events_remain": """
        SELECT anonymous_id, event_type, event_timestamp, coalesce(product_id, -1) AS product_id_key, count(*) AS row_count
        FROM fct_events GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
    "sgl12_assert_no_negative_total_revenue": f"""
        SELECT {_sum("order_amount")} AS total_revenue FROM fct_orders WHERE order_status = 'completed'
        HAVING sum(order_amount) < 0""",
    "sgl13_assert_no_volume_anomaly": """
        SELECT source_name, period_id, period_start_date, row_count, trailing_avg_row_count, pct_change_vs_trailing_avg
        FROM mart_volume_anomalies WHERE is_anomaly""",
    "sgl14_assert_reconciliation_matches_source_facts": """
        WITH booked AS (SELECT order_date AS d, order_amount AS a FROM fct_orders WHERE order_status = 'completed'
                        UNION ALL SELECT invoice_date, invoice_amount FROM fct_invoices),
        again AS (SELECT period_id, CAST(sum(a) AS DECIMAL(18,2)) AS recomputed_total_net_booked_revenue
                  FROM booked JOIN accounting_periods ON d BETWEEN period_start_date AND period_end_date GROUP BY 1)
        SELECT period_id, total_net_booked_revenue, recomputed_total_net_booked_revenue
        FROM (SELECT p.period_id, total_net_booked_revenue,
                     CAST(coalesce(recomputed_total_net_booked_revenue, 0) AS DECIMAL(18,2))
                         AS recomputed_total_net_booked_revenue
              FROM mart_revenue_reconciliation_by_period p LEFT JOIN again USING (period_id)) AS every_period
        WHERE total_net_booked_revenue <> recomputed_total_net_booked_revenue""",
    "sgl15_assert_refunded_retail_payments_net_to_zero": """
        WITH r AS (SELECT period_id, CAST(sum(amount) AS DECIMAL(18,2)) AS refunded_amount FROM stg_payments
                   JOIN accounting_periods ON payment_date BETWEEN period_start_date AND period_end_date
                   WHERE payment_status = 'refunded' GROUP BY 1)
        SELECT period_id, refunded_amount, retail_cash_in, retail_cash_out
        FROM r JOIN mart_cash_movements_by_period USING (period_id)
        WHERE retail_cash_in < refunded_amount OR retail_cash_out <> refunded_amount""",
    "sgl16_assert_scenario_14_produces_two_sessions": """
        SELECT customer_id, count(DISTINCT session_id) AS session_count FROM fct_events WHERE customer_id = 14
        GROUP BY 1 HAVING count(DISTINCT session_id) <> 2""",
    "sgl17_assert_subscription_phases_do_not_overlap": """
        SELECT * FROM (SELECT subscription_id, subscription_chain_id, phase_start_date, phase_end_date,
                              lead(phase_start_date) OVER (PARTITION BY subscription_chain_id
                                                           ORDER BY phase_start_date, subscription_id)
                                  AS next_phase_start_date FROM fct_subscriptions) AS o
        WHERE phase_end_date > next_phase_start_date""",
}


def _with_fault(query: str, fault: Fault | Lost, name: str = "faulty") -> str:
    """The query over its table with the fault in it."""
    faulty = f"{name}_{query.split('_')[0]}"
    VIEWS[faulty] = fault.view()
    return re.sub(rf"\b{fault.table}\b", faulty, SQL[query])


for _query in [q for q in SQL if q.startswith("sgl")]:
    _number, _check = _query.split("_", 1)
    if _check in FAULTS:
        SQL[f"{_number}_fault_{_check}"] = _with_fault(_query, FAULTS[_check])
    if _check in LOST:
        SQL[f"{_number}_fault_lost_{_check}"] = _with_fault(_query, LOST[_check], "lost")
SQL["chk6_fault_not_negative"] = _with_fault("chk6_not_negative", NEGATIVE_PAYMENTS)
SQL |= {f"chk9_contract_{name}": f"SELECT * FROM {name}" for name in CONTRACTS}
SQL |= {
    "str1_events_deduplicated": """
        SELECT DISTINCT anonymous_id, event_type, event_timestamp, product_id FROM stg_events__events""",
    "str2_closed_sessions": """
        SELECT anonymous_id, session_start, session_end, event_count, converted FROM fct_sessions
        WHERE session_end + INTERVAL 30 MINUTE <= (SELECT max(event_timestamp) FROM stg_events__events) - INTERVAL 1 HOUR""",
    "chk13_check_results": _check_results(),
    "chk13_check_summary": f"SELECT status, count(*) AS checks FROM ({_check_results()}) AS r GROUP BY 1",
    "bi8_alert": f"""
        SELECT 'failing check' AS section, "check" AS item, status, CAST(failing_rows AS DECIMAL(18,1)) AS value
        FROM ({_check_results()}) AS r WHERE status = 'fail'
        UNION ALL
        SELECT 'late adjustment', CAST(refund_id AS VARCHAR), 'informational', days_after_close FROM ({_LATE}) AS l""",
    "bi9_health": f"""
        SELECT 'checks' AS section, status AS item, status, CAST(count(*) AS DECIMAL(18,1)) AS value
        FROM ({_check_results()}) AS r GROUP BY status
        UNION ALL SELECT 'source freshness', source_name, status, NULL FROM ({_FRESHNESS}) AS f WHERE status <> 'pass'
        UNION ALL SELECT 'contract', unnest(['fct_orders', 'fct_invoices', 'mart_cash_movements_by_period',
                                             'mart_revenue_reconciliation_by_period']), 'enforced', NULL
        UNION ALL SELECT 'volume anomaly', source_name || '/' || period_id, 'anomaly', pct_change_vs_trailing_avg
                  FROM mart_volume_anomalies WHERE is_anomaly
        UNION ALL SELECT 'late adjustment', CAST(refund_id AS VARCHAR), 'informational', days_after_close
                  FROM ({_LATE}) AS l""",
}
SQL.update({f"stg{i:02d}_{name}": f"SELECT * FROM {name}" for i, name in enumerate(STAGING_IDS, 1)})
SQL.update({f"md{i:02d}_{name}": f"SELECT * FROM {name}" for i, name in enumerate(MODEL_IDS, 1)})


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in SQL.items()}
