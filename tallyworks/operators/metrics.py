"""Governed metrics: declared once, asked for by name, rejected when they do not fit together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC_TIME = "metric_time"
GRAINS = ("day", "week", "month", "quarter", "year")

Predicate = Callable[[Column], Column]


class MetricError(ValueError):
    """The request names something unknown or combines things that share no grain."""


@dataclass(frozen=True)
class Entity:
    """A join key of a model. ``kind`` is ``primary`` (one row per key) or ``foreign``."""

    name: str
    kind: str
    expr: str | None = None


@dataclass(frozen=True)
class Dimension:
    """A grouping column; a ``grain`` makes it a time dimension."""

    name: str
    expr: str | None = None
    grain: str | None = None


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str | None = None


@dataclass(frozen=True)
class SemanticModel:
    name: str
    table: str
    entities: tuple[Entity, ...]
    dimensions: tuple[Dimension, ...] = ()
    measures: tuple[Measure, ...] = ()
    time_dimension: str | None = None
    primary_entity: str | None = None

    @property
    def key(self) -> str | None:
        """Name under which the model's own dimensions are addressed."""
        declared = [e.name for e in self.entities if e.kind == "primary"]
        return declared[0] if declared else self.primary_entity

    def entity(self, name: str) -> Entity | None:
        return next((e for e in self.entities if e.name == name), None)

    def dimension(self, name: str) -> Dimension | None:
        return next((d for d in self.dimensions if d.name == name), None)


@dataclass(frozen=True)
class Metric:
    """Simple: one measure, optionally filtered. Derived: a formula over other metrics."""

    name: str
    measure: str | None = None
    filter: Mapping[str, Predicate] = field(default_factory=dict)
    inputs: tuple[str, ...] = ()
    formula: Callable[[Mapping[str, Column]], Column] | None = None


@dataclass(frozen=True)
class _Item:
    """A group-by or filter name resolved against one model."""

    name: str
    dimension: Dimension
    grain: str | None
    via: Entity | None = None
    owner: SemanticModel | None = None


class Registry:
    """All models and metrics, checked for consistency when it is built."""

    def __init__(self, models: Sequence[SemanticModel], metrics: Sequence[Metric]) -> None:
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}
        self._measures: dict[str, SemanticModel] = {}
        owners: dict[tuple[str, str], str] = {}
        for model in models:
            for measure in model.measures:
                if measure.name in self._measures:
                    raise MetricError(f"measure {measure.name} is declared twice")
                self._measures[measure.name] = model
            for dimension in model.dimensions:
                owner = owners.setdefault((model.key, dimension.name), model.name)
                if owner != model.name:
                    raise MetricError(
                        f"{owner} and {model.name} both declare {model.key}__{dimension.name}"
                    )
        for metric in metrics:
            for name in metric.inputs:
                if name not in self.metrics:
                    raise MetricError(f"metric {metric.name} needs unknown metric {name}")
            if metric.measure is not None and metric.measure not in self._measures:
                raise MetricError(f"metric {metric.name} needs unknown measure {metric.measure}")

    def metric(self, name: str) -> Metric:
        if name not in self.metrics:
            raise MetricError(f"unknown metric {name}")
        return self.metrics[name]

    def simple_metrics(self, name: str) -> list[Metric]:
        """The simple metrics a metric is computed from."""
        metric = self.metric(name)
        if metric.measure is not None:
            return [metric]
        return [simple for part in metric.inputs for simple in self.simple_metrics(part)]

    def model_of(self, metric: Metric) -> SemanticModel:
        return self._measures[metric.measure]

    def items_of(self, model: SemanticModel) -> list[str]:
        """Every name the model's metrics can be grouped by."""
        names = [METRIC_TIME] if model.time_dimension else []
        names += [f"{model.key}__{d.name}" for d in model.dimensions]
        for entity in model.entities:
            for other in self.models.values():
                target = other.entity(entity.name)
                if other is not model and target is not None and target.kind == "primary":
                    names += [f"{entity.name}__{d.name}" for d in other.dimensions]
        return sorted(set(names))

    def dimensions_of(self, *metrics: str) -> list[str]:
        """Names shared by all the given metrics."""
        shared: set[str] | None = None
        for name in metrics:
            for simple in self.simple_metrics(name):
                items = set(self.items_of(self.model_of(simple)))
                shared = items if shared is None else shared & items
        return sorted(shared or ())

    def list_metrics(self) -> dict[str, list[str]]:
        return {name: self.dimensions_of(name) for name in sorted(self.metrics)}

    def resolve(self, model: SemanticModel, item: str) -> _Item:
        """Find the column behind ``metric_time[__grain]`` or ``entity__dimension[__grain]``."""
        head, _, tail = item.rpartition("__")
        base, grain = (head, tail) if head and tail in GRAINS else (item, None)
        if base == METRIC_TIME and model.time_dimension:
            dimension = model.dimension(model.time_dimension)
            return _Item(item, dimension, self._grain(item, dimension, grain))
        entity_name, _, dimension_name = base.partition("__")
        if entity_name == model.key and model.dimension(dimension_name):
            dimension = model.dimension(dimension_name)
            return _Item(item, dimension, self._grain(item, dimension, grain))
        via = model.entity(entity_name)
        if via is not None:
            for other in self.models.values():
                target, dimension = other.entity(entity_name), other.dimension(dimension_name)
                if other is not model and target is not None and target.kind == "primary" and dimension:
                    return _Item(item, dimension, self._grain(item, dimension, grain), via, other)
        raise MetricError(
            f"{item} cannot be reached from {model.name}; available: {', '.join(self.items_of(model))}"
        )

    @staticmethod
    def _grain(item: str, dimension: Dimension, grain: str | None) -> str | None:
        if dimension.grain is None:
            if grain is not None:
                raise MetricError(f"{item}: {dimension.name} is not a time dimension")
            return None
        wanted = grain or dimension.grain
        if GRAINS.index(wanted) < GRAINS.index(dimension.grain):
            raise MetricError(f"{item}: {dimension.name} is only known by {dimension.grain}")
        return wanted


def _value(item: _Item) -> Column:
    column = F.expr(item.dimension.expr or item.dimension.name)
    if item.grain is None:
        return column
    return F.date_trunc(item.grain, column).cast("date") if item.grain != "day" else column.cast("date")


def _holds(conditions: Mapping[str, Predicate]) -> Column:
    return reduce(lambda a, b: a & b, [test(F.col(name)) for name, test in conditions.items()])


def _restore(source: T.StructType, name: str, total: Column) -> Column:
    """Sums keep the type of what they add up (decimal sums would widen by ten digits)."""
    kind = source[name].dataType
    return total.cast(kind) if isinstance(kind, T.DecimalType) else total


def _aggregate(
    registry: Registry,
    model: SemanticModel,
    tables: Mapping[str, DataFrame],
    metrics: Sequence[Metric],
    group_by: Sequence[str],
    where: Mapping[str, Predicate],
) -> DataFrame:
    """All requested metrics of one model in one aggregation of its table."""
    names = list(dict.fromkeys([*group_by, *where, *[n for m in metrics for n in m.filter]]))
    items = [registry.resolve(model, n) for n in names]
    joined: dict[str, list[_Item]] = {}
    for item in items:
        if item.owner is not None:
            joined.setdefault(item.owner.name, []).append(item)
    used = {m.measure: next(x for x in model.measures if x.name == m.measure) for m in metrics}

    local = [_value(i).alias(i.name) for i in items if i.owner is None]
    keys = {i.via.name: F.expr(i.via.expr or i.via.name).alias(f"_key_{i.via.name}") for i in items if i.via}
    inputs = {}
    for measure in used.values():
        inputs[f"_m_{measure.name}"] = F.expr(measure.expr or measure.name)
    base = tables[model.table].select(*local, *keys.values(), *[c.alias(n) for n, c in inputs.items()])
    types = base.schema
    sums = [f"_m_{m.name}" for m in used.values() if m.agg == "sum"]
    counted = [f"_m_{m.name}" for m in used.values() if m.agg == "count_distinct"]

    if joined:
        # Fold the facts to one row per join key before they meet the dimension: a key with
        # very many facts is combined on the map side and the join stays small.
        grain = [i.name for i in items if i.owner is None] + [f"_key_{k}" for k in keys] + counted
        if sums:
            base = base.groupBy(*grain).agg(*[_restore(types, s, F.sum(s)).alias(s) for s in sums])
        else:
            base = base.select(*grain).distinct()
        for owner, wanted in joined.items():
            other, via = registry.models[owner], wanted[0].via
            target = other.entity(via.name)
            dims = tables[other.table].select(
                F.expr(target.expr or target.name).alias(f"_dim_{via.name}"),
                *[_value(i).alias(i.name) for i in wanted],
            )
            base = base.join(dims, F.col(f"_key_{via.name}") == F.col(f"_dim_{via.name}"), "left")
    if where:
        base = base.filter(_holds(where))

    if len(counted) == 1 and not sums:
        return _count_once(base, metrics, group_by, counted[0])
    outputs, present = [], []
    for metric in metrics:
        source = F.col(f"_m_{metric.measure}")
        condition = _holds(metric.filter) if metric.filter else None
        picked = source if condition is None else F.when(condition, source)
        if used[metric.measure].agg == "sum":
            value = _restore(types, f"_m_{metric.measure}", F.sum(picked))
        else:
            value = F.countDistinct(picked)
        outputs.append(value.alias(metric.name))
        present.append((F.lit(True) if condition is None else F.bool_or(condition)).alias(f"_has_{metric.name}"))
    return _present_only(base.groupBy(*group_by).agg(*outputs, *present), metrics, group_by)


def _count_once(df: DataFrame, metrics: Sequence[Metric], group_by: Sequence[str], key: str) -> DataFrame:
    """Distinct counts of one key under several filters: one row per key first, then count flags."""
    hit = {m.name: _holds(m.filter) if m.filter else F.lit(True) for m in metrics}
    once = df.groupBy(*group_by, key).agg(*[F.bool_or(c).alias(f"_hit_{n}") for n, c in hit.items()])
    flags = [
        (F.count_if(F.col(f"_hit_{n}") & F.col(key).isNotNull()).alias(n), F.bool_or(f"_hit_{n}").alias(f"_has_{n}"))
        for n in hit
    ]
    return _present_only(once.groupBy(*group_by).agg(*[c for pair in flags for c in pair]), metrics, group_by)


def _present_only(df: DataFrame, metrics: Sequence[Metric], group_by: Sequence[str]) -> DataFrame:
    """A filtered metric has no value in a group none of whose rows pass its filter."""
    if not any(m.filter for m in metrics):
        return df.select(*group_by, *[m.name for m in metrics])
    values = [F.when(F.col(f"_has_{m.name}"), F.col(m.name)).alias(m.name) for m in metrics]
    if group_by:
        df = df.filter(reduce(lambda a, b: a | b, [F.coalesce(f"_has_{m.name}", F.lit(False)) for m in metrics]))
    return df.select(*group_by, *values)


def metric_query(
    registry: Registry,
    tables: Mapping[str, DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    where: Mapping[str, Predicate] | None = None,
) -> DataFrame:
    """One row per group with the requested metrics; one total row without ``group_by``.

    Every name is resolved before any plan is built, so a combination that shares no grain is
    rejected, never guessed. Each model is aggregated once, the small results are stacked and
    grouped by the keys, and derived metrics are formulas over those aggregates (a ratio of sums,
    not a mean of ratios).
    """
    where = dict(where or {})
    needed = {m.name: m for name in metrics for m in registry.simple_metrics(name)}
    by_model: dict[str, list[Metric]] = {}
    for metric in needed.values():
        by_model.setdefault(registry.model_of(metric).name, []).append(metric)
    for model_name in by_model:
        for item in [*group_by, *where]:
            registry.resolve(registry.models[model_name], item)

    parts = [
        _aggregate(registry, registry.models[model_name], tables, wanted, list(group_by), where)
        for model_name, wanted in by_model.items()
    ]
    aligned = _align(parts, group_by)

    def value(name: str) -> Column:
        metric = registry.metric(name)
        if metric.measure is not None:
            return F.col(name)
        return metric.formula({part: value(part) for part in metric.inputs})

    return aligned.select(*group_by, *[value(name).alias(name) for name in metrics])


def _align(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Aggregates of several models side by side: stacked, and grouped once by the keys.

    Each part has one row a group at most, so the only value of a metric in a group is its largest. A NULL
    key is a group like any other; without keys all rows make one. One exchange, however many models.
    """
    if len(parts) == 1:
        return parts[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])
