"""Canonical retail, billing and event tables derived from the generic star-schema test tables.

Everything is a Spark job over the whole tables and deterministic. Windows here run over one row
per (customer, order date), so even a customer with a third of all orders stays bounded by the
days of history; item lines are merged by partial aggregation instead of being ranked.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.functions.columns import cents, money
from tallyworks.operators.joins import join_hot
from tallyworks.operators.periods import make_accounting_periods
from tallyworks.session import DROP_SHUFFLES, settings
from tallyworks.sources.tables import write_scratch

# The columns of the test tables; a declared schema spares a job per file to infer it.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
ADD_ON_PRICE = 5
MAX_GAP_DAYS = 180
LAST_PHASE_DAYS = 120
EVENT_TYPES = {"view": "product_view", "click": "add_to_cart", "error": "checkout_start"}


def _once(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build a table's plan once per ``TestTables``: plans are immutable and cheap to share."""

    @wraps(make)
    def memo(self: TestTables, *args: str) -> DataFrame:
        key = (make.__name__, *args)
        if key not in self._plans:
            self._plans[key] = make(self, *args)
        return self._plans[key]

    return memo


class TestTables:
    """Lazy canonical tables over one test-data directory."""

    __test__ = False

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._plans: dict[tuple[str, ...], DataFrame] = {}

    @_once
    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    def share(self, *chains: tuple[str, ...]) -> None:
        """Compute once what a query makes several tables from: the tables of a chain in turn, chains side by side.

        Like ``Warehouse.share`` they are written to the shared scratch folder and read back; without one they stay lazy.
        """

        def write(chain: tuple[str, ...]) -> None:
            for name in chain:
                self._plans[name,] = write_scratch(getattr(self, name)())

        with settings(self.spark, DROP_SHUFFLES), ThreadPoolExecutor(max(1, len(chains))) as pool:
            list(pool.map(write, chains))

    # -- reference tables ---------------------------------------------------------------

    @_once
    def _calendar_bounds(self) -> DataFrame:
        day = F.to_date("o_orderdate")
        return self.read("orders").agg(
            F.trunc(F.min(day), "MM").alias("first_month"),
            F.add_months(F.trunc(F.max(day), "MM"), 4).alias("last_month"),
        )

    @_once
    def accounting_periods(self) -> DataFrame:
        """Months from the first order to four months after the last."""
        return make_accounting_periods(self._calendar_bounds())

    @_once
    def calendar_bounds(self) -> DataFrame:
        """First order date to one year after the last: the day calendar's range."""
        day = F.to_date("o_orderdate")
        return self.read("orders").agg(
            F.min(day).alias("start_date"), F.add_months(F.max(day), 12).alias("end_date")
        )

    @_once
    def tax_rates(self) -> DataFrame:
        """A rate per nation; the highest nation key has none, to keep the missing-rate case."""
        nation = self.read("nation")
        last = nation.agg(F.max("n_nationkey")).scalar()
        return nation.filter(F.col("n_nationkey") < last).select(
            F.col("n_name").alias("region"),
            ((F.col("n_nationkey") % 10).cast("decimal(6,4)") / 100).cast("decimal(6,4)").alias("tax_rate"),
        )

    # -- retail -------------------------------------------------------------------------

    @_once
    def customers(self) -> DataFrame:
        places = self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", F.col("n_name").alias("region"), F.col("r_name").alias("country"))
        signups = self.read("orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("signup_date"))
        name = F.col("c_name")
        return (
            self.read("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(signups, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.split_part(name, F.lit("#"), F.lit(1)).alias("first_name"),
                F.split_part(name, F.lit("#"), F.lit(2)).alias("last_name"),
                F.concat(name, F.lit("@Example.com")).alias("email"),
                "signup_date",
                "region",
                "country",
            )
        )

    @_once
    def products(self) -> DataFrame:
        price = money("p_retailprice")
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.round(price * F.lit("0.61234").cast("decimal(6,5)"), 4).cast("double").alias("unit_cost"),
            (price + F.lit("0.0045").cast("decimal(4,4)")).cast("double").alias("unit_price"),
            (F.col("p_size") <= 47).alias("is_active"),
        )

    @_once
    def orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.when(status == "F", "completed").when(status == "O", "cancelled").otherwise("refunded").alias("status"),
            F.col("o_orderpriority").alias("channel"),
        )

    @_once
    def _merged(self) -> DataFrame:
        """One row per (order, line number); repeated lines are merged on the map side.

        Flags are compared by character code: a minimum of text would force a sort-based
        aggregation, a minimum of integers keeps the hash-based one. Prices are added up as whole cents: a sum
        of decimals takes three times the room in each row.
        """
        extended = (F.col("_cents") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")
        return (
            self.read("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
                F.sum(cents("l_extendedprice")).alias("_cents"),
                F.max("l_discount").alias("discount"),
                F.min("l_partkey").alias("product_id"),
                F.min(F.ascii("l_returnflag")).alias("_flag"),
                F.min(F.ascii("l_linestatus")).alias("_method"),
            )
            .select(
                F.col("l_orderkey").alias("order_id"),
                "l_linenumber",
                "product_id",
                "quantity",
                # prices under a cent and discounts past four places, as raw extracts may have them
                F.round(extended / F.col("quantity").cast("decimal(10,0)"), 4)
                .cast("decimal(18,4)")
                .alias("unit_price"),
                (F.col("discount").cast("decimal(4,2)") * F.lit("0.33333").cast("decimal(6,5)"))
                .cast("decimal(9,8)")
                .alias("discount"),
                "_flag",
                "_method",
            )
        )

    @_once
    def _lines(self) -> DataFrame:
        """Item lines with their keys, which are as quick to work out as to read."""
        return self._merged().select((F.col("order_id") * 100 + F.col("l_linenumber")).alias("order_item_id"), "*")

    @_once
    def order_items(self) -> DataFrame:
        return self._lines().select(
            "order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount"
        )

    @_once
    def payments(self) -> DataFrame:
        """One payment per order item, ten days apart by line number."""
        price = F.col("unit_price").cast("decimal(16,4)")
        amount = F.round(F.col("quantity").cast("decimal(10,0)") * price * (1 - F.col("discount")), 2)
        lines = self._lines().select(
            "order_item_id", "order_id", "l_linenumber", money(amount).alias("amount"), "_flag", "_method"
        )
        status = (
            F.when(F.col("_flag") == ord("N"), "succeeded").when(F.col("_flag") == ord("A"), "failed").otherwise("refunded")
        )
        return lines.join(self.orders().select("order_id", "order_date"), "order_id").select(
            F.col("order_item_id").alias("payment_id"),
            "order_id",
            F.date_add("order_date", (F.col("l_linenumber") * 10).cast("int")).alias("payment_date"),
            "amount",
            F.char("_method").alias("payment_method"),
            status.alias("status"),
        )

    # -- billing ------------------------------------------------------------------------

    @_once
    def plans(self) -> DataFrame:
        """Six plans, one per class of part sizes, at a share of the class's lowest price; two of them nobody buys."""
        number = (F.col("p_size") % 6 + 1).cast("long")
        lowest = self.read("part").groupBy(number.alias("plan_id")).agg(F.min(money("p_retailprice")).alias("_lowest"))
        monthly = F.col("plan_id") % 2 == 1
        share = F.when(monthly, F.lit("0.01").cast("decimal(3,2)")).otherwise(F.lit("0.1").cast("decimal(3,2)"))
        return lowest.select(
            "plan_id",
            F.concat(F.lit("Plan "), F.col("plan_id").cast("string")).alias("plan_name"),
            F.when(monthly, "monthly").otherwise("annual").alias("billing_interval"),
            F.round(F.col("_lowest") * share, 2).cast("double").alias("price"),
            F.lit("USD").alias("currency"),
        )

    @_once
    def _phases(self) -> DataFrame:
        return (
            self.read("orders")
            .groupBy(F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("phase_start_date"))
            .agg(F.min("o_orderkey").alias("subscription_id"))
            .withColumn("plan_id", F.col("subscription_id") % 4 + 1)
        )

    @_once
    def subscriptions(self) -> DataFrame:
        """One phase per distinct (customer, order date); the customer is the chain."""
        by_date = Window.partitionBy("customer_id").orderBy("phase_start_date")
        start = F.col("phase_start_date")
        timeline = self._phases().select(
            "*",
            F.row_number().over(by_date).alias("_n"),
            F.lag("phase_start_date").over(by_date).alias("_prev_start"),
            F.lag("subscription_id").over(by_date).alias("_prev_id"),
            F.lag("plan_id").over(by_date).alias("_prev_plan"),
            F.lead("phase_start_date").over(by_date).alias("_next_start"),
            F.lead("plan_id").over(by_date).alias("_next_plan"),
        )
        sid, plan = F.col("subscription_id"), F.col("plan_id")
        gap_ahead = F.datediff("_next_start", start) > MAX_GAP_DAYS
        gap_behind = F.datediff(start, "_prev_start") > MAX_GAP_DAYS
        after_trial = (F.col("_n") == 2) & (F.col("_prev_id") % 5 == 0)
        end = (
            F.when(gap_ahead, F.date_add(start, MAX_GAP_DAYS))
            .when(F.col("_next_start").isNotNull(), F.col("_next_start"))
            .when(sid % 3 == 0, F.date_add(start, LAST_PHASE_DAYS))
        )
        kind = (
            F.when((F.col("_n") == 1) & (sid % 5 == 0), "trial")
            .when(F.col("_n") == 1, "new")
            .when(gap_behind, "reactivation")
            .when(after_trial, "new")
            .when(plan >= F.col("_prev_plan"), "upgrade")
            .otherwise("downgrade")
        )
        stopped = gap_ahead | F.col("_next_start").isNull()
        reason = (
            F.when(stopped, F.when(sid % 2 == 0, "cancelled").otherwise("paused"))
            .when(F.col("_next_plan") >= plan, "upgraded")
            .otherwise("downgraded")
        )
        return timeline.select(
            "subscription_id",
            F.col("customer_id").alias("subscription_chain_id"),
            "customer_id",
            "plan_id",
            "phase_start_date",
            end.alias("phase_end_date"),
            kind.alias("phase_type"),
            (kind == "trial").alias("is_trial"),
            F.when(end.isNotNull(), reason).alias("ended_reason"),
        )

    @_once
    def _billed(self) -> DataFrame:
        """Billing runs of every paid phase, one per full plan interval."""
        data_end = self.read("orders").agg(F.last_day(F.max(F.to_date("o_orderdate")))).scalar()
        until = F.coalesce("phase_end_date", data_end)
        step = F.when(F.col("plan_id").isin(1, 3), 1).otherwise(12)
        paid = self.subscriptions().filter(~F.col("is_trial")).select(
            "subscription_id", "customer_id", "plan_id", "phase_start_date", until.alias("_until"), step.alias("_step")
        )
        # As many runs as could fit are numbered, then those that end in time are kept.
        months = F.months_between("_until", "phase_start_date").cast("int") + 1
        runs = F.when(months >= 0, F.sequence(F.lit(0), (months / F.col("_step")).cast("int")))
        numbered = paid.select("*", F.explode(runs).alias("i"))
        end = F.date_sub(F.add_months("phase_start_date", ((F.col("i") + 1) * F.col("_step")).cast("int")), 1)
        sid, i = F.col("subscription_id"), F.col("i")
        price = self.plans().select("plan_id", money("price").alias("_price"))
        return (
            join_hot(numbered, price, "plan_id")
            .select("*", end.alias("period_end"))
            .filter(F.col("period_end") <= F.col("_until"))
            .select(
                (sid * 1000 + i).alias("invoice_id"),
                "subscription_id",
                "customer_id",
                F.add_months("phase_start_date", (i * F.col("_step")).cast("int")).alias("period_start"),
                "period_end",
                "_price",
                (sid + 7 * i).alias("_mix"),
            )
        )

    def _amount(self) -> Column:
        add_on = F.when(F.col("_mix") % 10 == 0, ADD_ON_PRICE).otherwise(0).cast("decimal(18,2)")
        return money(F.col("_price") + add_on)

    @_once
    def invoices(self) -> DataFrame:
        return self._billed().select(
            "invoice_id",
            "subscription_id",
            "customer_id",
            F.col("period_start").alias("invoice_date"),
            "period_start",
            "period_end",
            self._amount().alias("amount"),
        )

    @_once
    def invoice_lines(self) -> DataFrame:
        fee = F.struct(F.lit(1).alias("n"), F.lit("plan fee").alias("description"), F.col("_price").alias("amount"))
        add_on = F.struct(
            F.lit(2).alias("n"),
            F.lit("add-on").alias("description"),
            F.lit(ADD_ON_PRICE).cast("decimal(18,2)").alias("amount"),
        )
        lines = F.when(F.col("_mix") % 10 == 0, F.array(fee, add_on)).otherwise(F.array(fee))
        return self._billed().select("invoice_id", "subscription_id", F.explode(lines).alias("line")).select(
            (F.col("invoice_id") * 10 + F.col("line.n")).alias("invoice_line_id"),
            "invoice_id",
            "subscription_id",
            F.col("line.description").alias("description"),
            F.lit(1).cast("long").alias("quantity"),
            F.col("line.amount").alias("unit_amount"),
            F.col("line.amount").alias("amount"),
        )

    @_once
    def _attempts(self) -> DataFrame:
        """Payment attempts: unpaid, retried, half paid, late and plain invoices by mix key."""
        case, days = F.col("_mix") % 20, F.col("_mix") % 4
        tries = F.when(case == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        retry = F.col("attempt") == 1
        delay = F.when(case == 3, 45).otherwise(days) + F.when(retry, 4).otherwise(0)
        paid = F.when(case == 2, F.round(self._amount() / 2, 2)).otherwise(self._amount())
        return self._billed().withColumn("attempt", F.explode(tries)).select(
            (F.col("invoice_id") * 10 + F.col("attempt")).alias("payment_id"),
            "invoice_id",
            F.date_add("period_start", delay.cast("int")).alias("payment_date"),
            money(paid).alias("amount"),
            F.when(F.col("invoice_id") % 2 == 0, "card").otherwise("transfer").alias("payment_method"),
            F.when((case == 0) | ((case == 1) & ~retry), "failed").otherwise("succeeded").alias("status"),
            retry.alias("is_retry"),
            "_mix",
        )

    @_once
    def billing_payments(self) -> DataFrame:
        return self._attempts().drop("_mix")

    @_once
    def refunds(self) -> DataFrame:
        """Full refunds after 50 days and half refunds after 20, on succeeded payments."""
        full, half = F.col("_mix") % 23 == 0, F.col("_mix") % 23 == 1
        return self._attempts().filter((F.col("status") == "succeeded") & (full | half)).select(
            F.col("payment_id").alias("refund_id"),
            "payment_id",
            F.date_add("payment_date", F.when(full, 50).otherwise(20)).alias("refund_date"),
            F.when(full, F.col("amount")).otherwise(money(F.round(F.col("amount") / 2, 2))).alias("amount"),
            F.when(full, "returned").otherwise("goodwill").alias("reason"),
        )

    # -- events -------------------------------------------------------------------------

    @_once
    def events(self) -> DataFrame:
        """Two anonymous ids per user, one user in five never identified, some events sent twice."""
        user, event = F.col("user_id"), F.col("event_id")
        kind = F.coalesce(
            F.element_at(F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair]), F.col("event_type")),
            F.col("event_type"),
        )
        identified = F.col("event_type").isin("signup", "purchase") & (user % 5 != 0)
        # The source has no exact copies: every fiftieth event gets one under a new id.
        copies = F.when(event % 50 == 0, F.array(F.lit(0), F.lit(1_000_000_000))).otherwise(F.array(F.lit(0)))
        shift = F.make_dt_interval(days=(user % 20 * 30 - 8766).cast("int"))
        return self.read("events").withColumn("_offset", F.explode(copies)).select(
            (event + F.col("_offset")).alias("event_id"),
            F.concat(F.lit("anon_"), user.cast("string"), F.lit("_"), (event % 2).cast("string")).alias("anonymous_id"),
            F.when(identified, user.cast("double")).alias("customer_id"),
            kind.alias("event_type"),
            (F.col("ts").cast("timestamp_ntz") + shift).alias("event_timestamp"),
            (event % 200).cast("double").alias("product_id"),
            F.when(F.col("event_type") == "purchase", event.cast("double")).alias("order_id"),
            F.when(F.col("event_type") == "view", F.col("props")).alias("search_query"),
        )

    def sources(self) -> dict[str, DataFrame]:
        """Everything the warehouse reads, by ``source.table`` name."""
        return {name: make() for name, make in self.makers().items()}

    def makers(self):
        return {
            "raw.customers": self.customers,
            "raw.products": self.products,
            "raw.orders": self.orders,
            "raw.order_items": self.order_items,
            "raw.payments": self.payments,
            "raw_billing.plans": self.plans,
            "raw_billing.subscriptions": self.subscriptions,
            "raw_billing.invoices": self.invoices,
            "raw_billing.invoice_lines": self.invoice_lines,
            "raw_billing.payments": self.billing_payments,
            "raw_billing.refunds": self.refunds,
            "raw_events.events": self.events,
            "accounting_periods": self.accounting_periods,
            "calendar_bounds": self.calendar_bounds,
            "tax_rates": self.tax_rates,
        }
