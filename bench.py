"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose the
input and the cores. Every query runs once, over its whole tables, into a no-op sink; one run of
the first query beforehand, untimed, gets the JVM out of its start-up phase.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tallyworks.queries import QUERIES
from tallyworks.session import local_session

HEADLINE = (
    "md25_fct_orders",
    "md01_int_order_items_enriched",
    "md22_dim_customers",
    "md14_int_revenue_by_period_retail",
    "md16_int_cash_movements_retail",
    "md04_int_invoice_payment_status",
    "md08_int_subscription_mrr_by_chain_month",
    "md09_int_subscription_mrr_movements",
    "md31_mart_monthly_recurring_revenue",
    "md32_mart_mrr_movements",
    "md33_mart_retention_cohorts",
    "md34_mart_customer_lifetime_value",
    "md13_int_sessions",
    "md38_fct_sessions",
    "md39_mart_funnel_conversion",
    "md40_mart_activation",
    "md18_int_period_close_adjustments",
    "md19_int_active_customers_by_period",
    "md43_mart_revenue_reconciliation_by_period",
    "md44_mart_cash_movements_by_period",
    "md45_mart_volume_anomalies",
    "hx1_scd2_customers",
    "chk13_check_results",
    "sem10_joined_distinct",
    "bi1_scorecard",
)


def run(spark: SparkSession, name: str, directory: str) -> None:
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=cores)
    run(spark, HEADLINE[0], directory)
    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        run(spark, name, directory)
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
