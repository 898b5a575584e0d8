"""The ten named billing scenarios as small source tables (fixed expectations per customer)."""

from tests_helpers import d

SUBSCRIPTIONS = "subscription_id long, subscription_chain_id long, customer_id long, plan_id long, " \
    "phase_start_date date, phase_end_date date, phase_type string, is_trial boolean, ended_reason string"
INVOICES = "invoice_id long, subscription_id long, customer_id long, invoice_date date, period_start date, " \
    "period_end date, amount double"
LINES = "invoice_line_id long, invoice_id long, subscription_id long, description string, quantity long, " \
    "unit_amount double, amount double"
PAYMENTS = "payment_id long, invoice_id long, payment_date date, amount double, payment_method string, " \
    "status string, is_retry boolean"
REFUNDS = "refund_id long, payment_id long, refund_date date, amount double, reason string"
PLANS = "plan_id long, plan_name string, billing_interval string, price double, currency string"


def phases():
    def phase(i, customer, plan, start, end, kind, reason=None):
        return (i, 100 + customer, customer, plan, d(start), d(end), kind, kind == "trial", reason)

    return [
        phase(1, 1, 1, "2025-01-15", None, "new"),
        phase(2, 2, 4, "2025-02-01", None, "new"),
        phase(3, 3, 1, "2025-03-01", "2025-03-15", "trial", "upgraded"),
        phase(4, 3, 1, "2025-03-15", None, "new"),
        phase(5, 4, 1, "2025-01-01", "2025-06-01", "new", "upgraded"),
        phase(6, 4, 3, "2025-06-01", None, "upgrade"),
        phase(7, 5, 3, "2025-01-01", "2025-07-01", "new", "downgraded"),
        phase(8, 5, 1, "2025-07-01", None, "downgrade"),
        phase(9, 6, 1, "2025-01-01", "2025-04-01", "new", "cancelled"),
        phase(10, 7, 1, "2025-01-01", "2025-03-01", "new", "cancelled"),
        phase(11, 7, 1, "2025-08-01", None, "reactivation"),
        phase(12, 8, 3, "2025-01-01", "2025-05-01", "new", "paused"),
        phase(13, 8, 3, "2025-09-01", None, "reactivation"),
        phase(14, 9, 2, "2024-06-01", None, "new"),
        phase(15, 10, 3, "2025-01-01", None, "new"),
    ]


def invoices():
    def invoice(i, sub, customer, start, end, amount):
        return (i, sub, customer, d(start), d(start), d(end), amount)

    return [
        invoice(1, 1, 1, "2025-01-15", "2025-02-14", 9.99),
        invoice(2, 9, 6, "2025-03-01", "2025-03-31", 9.99),
        invoice(3, 10, 7, "2025-01-01", "2025-01-31", 9.99),
        invoice(4, 12, 8, "2025-01-01", "2025-01-31", 19.99),
        invoice(5, 14, 9, "2024-06-01", "2025-05-31", 99.0),
        invoice(6, 14, 9, "2025-06-01", "2026-05-31", 99.0),
        invoice(7, 15, 10, "2025-01-01", "2025-01-31", 24.99),
        invoice(8, 15, 10, "2025-02-01", "2025-02-28", 19.99),
        invoice(9, 15, 10, "2025-03-01", "2025-03-31", 19.99),
        invoice(10, 11, 7, "2025-12-01", "2025-12-31", 9.99),
    ]


def lines():
    return [
        (1, 7, 15, "plan fee", 1, 19.99, 19.99),
        (2, 7, 15, "add-on", 1, 5.0, 5.0),
        (3, 1, 1, "plan fee", 1, 9.99, 9.99),
    ]


def payments():
    return [
        (1, 1, d("2025-01-16"), 9.99, "card", "succeeded", False),
        (2, 2, d("2025-03-01"), 9.99, "card", "failed", False),
        (3, 2, d("2025-03-05"), 9.99, "card", "succeeded", True),
        (4, 3, d("2025-01-01"), 9.99, "card", "succeeded", False),
        (5, 4, d("2025-01-01"), 19.99, "card", "succeeded", False),
        (6, 5, d("2024-06-01"), 49.5, "card", "succeeded", False),
        (7, 7, d("2025-01-02"), 24.99, "card", "succeeded", False),
        (8, 9, d("2025-04-15"), 19.99, "card", "succeeded", False),
        (9, 8, d("2025-02-01"), 19.99, "card", "failed", False),
    ]


def refunds():
    return [
        (1, 4, d("2025-02-20"), 9.99, "returned"),
        (2, 5, d("2025-01-20"), 9.99, "goodwill"),
        (3, 9, d("2025-02-02"), 1.0, "by mistake"),  # on a failed payment: ignored by invoices
        (4, 1, d("2025-02-10"), 1.0, "goodwill"),  # on the closing day itself: not late
    ]


def plans():
    return [
        (1, "Basic Monthly", "monthly", 9.99, "USD"),
        (2, "Basic Annual", "annual", 99.0, "USD"),
        (3, "Pro Monthly", "monthly", 19.99, "USD"),
        (4, "Pro Annual", "annual", 199.0, "USD"),
    ]
