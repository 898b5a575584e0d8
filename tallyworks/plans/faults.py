"""Planted faults: one column of one table changed so that a check must find something.

Each check that finds nothing in sound tables has a fault here, so that an operator which returns
nothing cannot pass for one that works. Expressions hold for both SQL dialects unless two are given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from tallyworks.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Fault:
    table: str
    column: str
    value: str
    oracle_value: str | None = None

    def plant(self, w: Warehouse) -> Warehouse:
        sound = w[self.table]
        w.use(self.table, sound.withColumn(self.column, F.expr(self.value)))
        return w

    def view(self) -> str:
        return f"SELECT * REPLACE ({self.oracle_value or self.value} AS {self.column}) FROM {self.table}"


@dataclass(frozen=True)
class Lost:
    """All rows of a table that meet a condition are missing."""

    table: str
    condition: str

    def plant(self, w: Warehouse) -> Warehouse:
        w.use(self.table, w[self.table].filter(~F.coalesce(F.expr(self.condition), F.lit(False))))
        return w

    def view(self) -> str:
        return f"SELECT * FROM {self.table} WHERE NOT coalesce({self.condition}, false)"


def _more(column: str) -> str:
    """Money that is off by one in every second period."""
    return f"CAST({column} + period_id % 2 AS DECIMAL(18,2))"


CASH, REVENUE = "mart_cash_movements_by_period", "mart_revenue_reconciliation_by_period"

FAULTS: dict[str, Fault] = {
    "assert_activation_purchase_not_before_signup": Fault(
        "mart_activation",
        "first_purchase_at",
        "CASE WHEN customer_id % 2 = 0 THEN first_signup_at - INTERVAL 1 DAY ELSE first_purchase_at END",
    ),
    "assert_annual_plans_normalize_to_monthly_mrr": Fault(
        "fct_subscriptions", "mrr_amount", "CAST(mrr_amount + 1 AS DECIMAL(18,2))"
    ),
    "assert_cash_movements_match_source_facts": Fault(CASH, "total_cash_in", _more("total_cash_in")),
    "assert_days_after_close_consistent_with_late_flag": Fault(
        "fct_period_close_adjustments",
        "days_after_close",
        "CASE WHEN refund_id % 2 = 0 THEN -1 ELSE days_after_close END",
    ),
    "assert_late_refund_lands_in_its_own_cash_period": Fault(CASH, "billing_cash_out", "CAST(0 AS DECIMAL(18,2))"),
    "assert_mrr_bridge_reconciles": Fault("mart_mrr_movements", "closing_mrr", "CAST(closing_mrr + 1 AS DECIMAL(18,2))"),
    "assert_no_duplicate_events_remain": Fault(
        "fct_events",
        "event_timestamp",
        "CAST(CAST('2000-01-01' AS DATE) AS TIMESTAMP_NTZ)",
        "CAST('2000-01-01' AS TIMESTAMP)",
    ),
    "assert_no_negative_total_revenue": Fault("fct_orders", "order_amount", "CAST(-order_amount AS DECIMAL(18,2))"),
    "assert_reconciliation_matches_source_facts": Fault(
        REVENUE, "total_net_booked_revenue", _more("total_net_booked_revenue")
    ),
    "assert_refunded_retail_payments_net_to_zero": Fault(CASH, "retail_cash_out", _more("retail_cash_out")),
}

#: A second fault of a check: what it looks for is not there at all.
LOST: dict[str, Lost] = {
    "assert_late_refund_lands_in_its_own_cash_period": Lost("fct_period_close_adjustments", "is_late_adjustment"),
    "assert_late_adjustment_scenario_exists": Lost("fct_period_close_adjustments", "is_late_adjustment"),
}

NEGATIVE_PAYMENTS = Fault(
    "fct_payments",
    "net_collected_amount",
    "CAST(CASE WHEN payment_id % 3 = 0 THEN -net_collected_amount ELSE net_collected_amount END AS DECIMAL(18,2))",
)
