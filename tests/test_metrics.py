import pytest
from pyspark.sql import functions as F
from tests_helpers import dec, plan_text, rows

from tallyworks.operators.metrics import (
    Dimension,
    Entity,
    Measure,
    Metric,
    MetricError,
    Registry,
    SemanticModel,
    metric_query,
)
from tallyworks.plans.governed import METRICS, MODELS, registry


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "people": spark.createDataFrame([(1, "N"), (2, "N"), (3, "S")], "person long, zone string"),
        "sales": spark.createDataFrame(
            [(1, 1, "a", 10), (2, 1, "b", 20), (3, 2, "a", 5), (4, 3, "b", 7), (5, 9, "a", 1), (6, None, "a", 2)],
            "sale long, person long, kind string, amount long",
        ),
        "visits": spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "visit long, person long"),
    }


@pytest.fixture(scope="module")
def small():
    models = [
        SemanticModel("people", "people", (Entity("person", "primary"),), (Dimension("zone"),)),
        SemanticModel(
            "sales",
            "sales",
            (Entity("sale", "primary"), Entity("person", "foreign")),
            (Dimension("kind"),),
            (Measure("amount", "sum"), Measure("buyers", "count_distinct", "person")),
        ),
        SemanticModel(
            "visits",
            "visits",
            (Entity("visit", "primary"), Entity("person", "foreign")),
            (),
            (Measure("visitors", "count_distinct", "person"),),
        ),
    ]
    metrics = [
        Metric("amount", "amount"),
        Metric("amount_b", "amount", {"sale__kind": lambda c: c == "b"}),
        Metric("buyers", "buyers"),
        Metric("visitors", "visitors"),
        Metric("per_buyer", inputs=("amount", "buyers"), formula=lambda m: m["amount"] / m["buyers"]),
    ]
    return Registry(models, metrics)


def test_joined_dimension_keeps_facts_without_partner(small, tables):
    got = rows(metric_query(small, tables, ["amount", "buyers"], ["person__zone"]))
    assert got == [("N", 35, 2), (None, 3, 1), ("S", 7, 1)]


def test_facts_are_folded_before_the_join(small, tables):
    plan = plan_text(metric_query(small, tables, ["amount"], ["person__zone"]))
    join = plan.index("Join")
    assert "partial_sum" in plan[join:], "a sum per join key below the join"


def test_filters_where_and_totals(small, tables):
    assert rows(metric_query(small, tables, ["amount"])) == [(45,)]
    assert rows(metric_query(small, tables, ["amount"], where={"sale__kind": lambda c: c == "a"})) == [(18,)]
    assert rows(metric_query(small, tables, ["amount_b"], ["person__zone"])) == [("N", 20), ("S", 7)]
    assert rows(metric_query(small, tables, ["amount", "amount_b"], ["person__zone"])) == [
        ("N", 35, 20),
        (None, 3, None),
        ("S", 7, 7),
    ]


def test_models_align_on_group_keys(small, tables):
    got = rows(metric_query(small, tables, ["amount", "visitors", "per_buyer"], ["person__zone"]))
    assert got == [("N", 35, 1, 17.5), (None, 3, None, 3.0), ("S", 7, 1, 7.0)]
    assert rows(metric_query(small, tables, ["amount", "visitors"])) == [(45, 2)]


def test_unreachable_combinations_are_rejected(small, tables):
    for metrics, group_by in (
        (["visitors"], ["sale__kind"]),
        (["amount", "visitors"], ["sale__kind"]),
        (["amount"], ["metric_time"]),
        (["nothing"], []),
        (["amount"], ["person__height"]),
    ):
        with pytest.raises(MetricError):
            metric_query(small, tables, metrics, group_by)
    with pytest.raises(MetricError):
        metric_query(small, tables, ["visitors"], where={"sale__kind": lambda c: c == "a"})


def test_conflicting_declarations_are_rejected():
    one = SemanticModel("one", "t", (Entity("k", "primary"),), (Dimension("x"),))
    two = SemanticModel("two", "t", (Entity("k", "primary"),), (Dimension("x"),))
    with pytest.raises(MetricError, match="both declare"):
        Registry([one, two], [])
    with pytest.raises(MetricError, match="unknown metric"):
        Registry([], [Metric("a", inputs=("b",))])
    with pytest.raises(MetricError, match="unknown measure"):
        Registry([], [Metric("a", "b")])


def test_catalogue():
    r = registry()
    assert len(MODELS) == 12 and len(METRICS) == 29
    listed = r.list_metrics()
    assert "customer_id__region" in listed["active_customers"]
    assert "period_id__is_closed" in listed["cash_in"]
    assert not any(name.startswith("customer_id") for name in listed["mrr"])
    assert set(r.dimensions_of("net_booked_revenue", "cash_in")) == {
        "metric_time",
        "period_id__is_closed",
        "period_id__period_start_date",
    }
    assert r.dimensions_of("mrr", "order_revenue") == ["metric_time"]


def test_catalogue_rejections(warehouse):
    r = registry()
    for metrics, item in (
        (["mrr"], "customer_id__region"),
        (["net_booked_revenue", "active_customers"], "period_id__is_closed"),
        (["viewers"], "customer_id__region"),
        (["mrr"], "metric_time__day"),
    ):
        with pytest.raises(MetricError):
            metric_query(r, warehouse, metrics, [item])


def test_ratio_of_sums(warehouse):
    curve = metric_query(registry(), warehouse, ["retention_rate"], ["retention_cohort__months_since_cohort_start"])
    (first,) = curve.filter("retention_cohort__months_since_cohort_start = 1").collect()
    cohorts = warehouse["mart_retention_cohorts"].filter("months_since_cohort_start = 1")
    sums = cohorts.agg(F.sum("active_chain_count").alias("a"), F.sum("cohort_size").alias("s")).first()
    assert first.retention_rate == sums.a / sums.s
    assert dec("0") < cohorts.agg(F.avg("retention_rate")).first()[0]
