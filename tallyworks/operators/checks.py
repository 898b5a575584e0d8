"""Data-quality checks. Each one yields its failing rows as a DataFrame; empty means pass.

``run_checks`` counts failures for many checks at once. All row-level checks of a table share a single
scan, or none at all where they were counted while the table was written (``row_counts``). All checks of
keys of one type, the uniqueness of keys and the children that refer to them, share one aggregation: the
columns are stacked with a tag each and grouped once by tag and key. ``count_checks`` does the same work at
once, with a job for each table and key: its shuffles are narrow, follow each other and can be dropped one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RowCheck:
    """A condition on single rows; a row fails only where ``failing()`` is true, so NULL passes."""

    table: str
    column: str

    kind = "row"

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"

    def failing(self) -> Column:
        raise NotImplementedError

    def failures(self, tables: Tables) -> DataFrame:
        return tables[self.table].filter(self.failing())


@dataclass(frozen=True)
class NotNull(RowCheck):
    kind = "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class NotNegative(RowCheck):
    kind = "not_negative"

    def failing(self) -> Column:
        return F.col(self.column) < 0


@dataclass(frozen=True)
class NotImplausiblyLarge(RowCheck):
    max_value: float = 0
    kind = "not_implausibly_large"

    def failing(self) -> Column:
        return F.col(self.column) > self.max_value


@dataclass(frozen=True)
class AcceptedRange(RowCheck):
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    kind = "accepted_range"

    def failing(self) -> Column:
        c = F.col(self.column)
        outside = []
        if self.min_value is not None:
            low = F.lit(self.min_value)
            outside.append(c < low if self.inclusive else c <= low)
        if self.max_value is not None:
            high = F.lit(self.max_value)
            outside.append(c > high if self.inclusive else c >= high)
        return reduce(lambda a, b: a | b, outside)


@dataclass(frozen=True)
class AcceptedValues(RowCheck):
    values: tuple[str, ...] = ()
    kind = "accepted_values"

    def failing(self) -> Column:
        return ~F.col(self.column).isin(*self.values)

    def failures(self, tables: Tables) -> DataFrame:
        """Unexpected values with their number of rows."""
        bad = tables[self.table].filter(self.failing())
        return bad.groupBy(F.col(self.column).alias("value")).agg(F.count("*").alias("n_records"))


@dataclass(frozen=True)
class Unique:
    """No value (or combination of values) occurs twice; NULL keys are ignored for one column."""

    table: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        kind = "unique" if len(self.columns) == 1 else "unique_combination"
        return f"{kind}_{self.table}_{'_'.join(self.columns)}"

    def failures(self, tables: Tables) -> DataFrame:
        df = tables[self.table].select(*self.columns)
        if len(self.columns) == 1:
            df = df.filter(F.col(self.columns[0]).isNotNull())
        counts = df.groupBy(*self.columns).agg(F.count("*").alias("n_records"))
        return counts.filter(F.col("n_records") > 1)


@dataclass(frozen=True)
class Relationships:
    """Every non-NULL child key exists in the parent; yields orphan keys with their child rows."""

    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"relationships_{self.table}_{self.column}__{self.parent}_{self.parent_column}"

    def failures(self, tables: Tables) -> DataFrame:
        # One row per key reaches the join from either side, so a key with very many rows is no skew.
        child = tables[self.table].filter(F.col(self.column).isNotNull())
        keys = child.groupBy(F.col(self.column).alias("orphan_key")).agg(F.count("*").alias("n_records"))
        parents = tables[self.parent].select(F.col(self.parent_column).alias("_key")).distinct()
        return keys.join(parents, F.col("orphan_key") == F.col("_key"), "left_anti")


@dataclass(frozen=True)
class RowsExpectedEmpty:
    """A query that returns offending rows (the named, hand-written checks)."""

    name: str
    table: str

    def failures(self, tables: Tables) -> DataFrame:
        return tables[self.table]

    def count(self, tables: Tables) -> DataFrame:
        return self.failures(tables).agg(F.count("*").alias("failing_rows"))


Check = RowCheck | Unique | Relationships | RowsExpectedEmpty


def row_counts(checks: Iterable[Check]) -> dict[str, dict[str, Column]]:
    """For each table, ``{check: number of failing rows}`` as aggregates, to be observed by the write of the table."""
    by_table: dict[str, dict[str, Column]] = {}
    for check in checks:
        if isinstance(check, RowCheck):
            by_table.setdefault(check.table, {})[check.name] = F.count_if(check.failing())
    return by_table


def _as_rows(counts: DataFrame, found: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row of counts as rows ``check, table, failing_rows``; ``found`` tells check, table and column."""
    pairs = [F.struct(F.lit(c).alias("check"), F.lit(t).alias("table"), F.col(column).alias("failing_rows")) for c, t, column in found]
    return counts.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def _row_check_counts(tables: Tables, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Failure counts of all row-level checks of one table, from one pass over it."""
    counts = tables[table].agg(*[count.alias(f"c{i}") for i, count in enumerate(checks.values())])
    return _as_rows(counts, [(name, table, f"c{i}") for i, name in enumerate(checks)])


_Key = tuple[str, tuple[str, ...]]


def key_domains(checks: Iterable[Check]) -> dict[_Key, list[Unique | Relationships]]:
    """Key checks by the key they are about: its own uniqueness, and every child that refers to it."""
    domains: dict[_Key, list[Unique | Relationships]] = {}
    for check in checks:
        if isinstance(check, Unique):
            domains.setdefault((check.table, check.columns), []).append(check)
        elif isinstance(check, Relationships):
            domains.setdefault((check.parent, (check.parent_column,)), []).append(check)
    return domains


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, as a balanced tree of unions: a chain of many is slow to analyse."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return _union(frames[:half]).unionByName(_union(frames[half:]))


def _domain_counts(tables: Tables, domains: Mapping[_Key, Sequence[Unique | Relationships]], first: int) -> DataFrame:
    """Failure counts of all checks about keys of one type, from one aggregation.

    Every column in its role (0: the key itself; from 1 on: a child's reference) is stacked with the number of
    its key and its role, and counted by key and role. Counting starts on the map side, so a key with very many
    rows is one row a task; a child's key is an orphan where role 0 has no row.
    """
    keys = [f"_k{i}" for i in range(len(next(iter(domains))[1]))]
    stacked, listed = [], []

    def stack(table: str, columns: Sequence[str], domain: int, role: int) -> None:
        picked = [F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)]
        part = tables[table].select(F.lit(domain).alias("_domain"), F.lit(role).alias("_role"), *picked)
        stacked.append(part.filter(F.col(keys[0]).isNotNull()) if len(columns) == 1 else part)

    for domain, ((table, columns), checks) in enumerate(domains.items(), first):
        stack(table, columns, domain, 0)
        children = [c for c in checks if isinstance(c, Relationships)]
        for role, check in enumerate(children, 1):
            stack(check.table, (check.column,), domain, role)
        listed += [(domain, children.index(c) + 1 if c in children else 0, c.name, c.table) for c in checks]
    roles = range(max(role for _, role, _, _ in listed) + 1)
    by_key = _union(stacked).groupBy("_domain", *keys).agg(*[F.count_if(F.col("_role") == r).alias(f"_n{r}") for r in roles])
    failing = [F.count_if(F.col("_n0") > 1)] + [F.sum(F.when(F.col("_n0") == 0, F.col(f"_n{r}"))) for r in roles[1:]]
    found = by_key.groupBy("_domain").agg(F.array(*failing).alias("_failing"))
    names = found.sparkSession.createDataFrame(listed, "_domain int, _role int, check string, `table` string")
    failing_rows = F.coalesce(F.element_at("_failing", F.col("_role") + 1), F.lit(0)).cast("long")
    # what is broadcast is one row a declared key
    return names.join(F.broadcast(found), "_domain", "left").select("check", "table", failing_rows.alias("failing_rows"))


Held = Mapping[str, tuple[str, Mapping[str, str]]]


def held_domains(checks: Iterable[Check], held: Held) -> dict[_Key, list[Unique | Relationships]]:
    """``key_domains``, with a key of a table and of the one that holds its rows as one."""
    domains: dict[_Key, list[Unique | Relationships]] = {}
    for (table, columns), group in key_domains(checks).items():
        holder, renamed = held.get(table, (table, {}))
        if set(columns) & set(renamed.values()):
            holder = table
        domains.setdefault((holder, columns), []).extend(group)
    return domains


def _key_check_counts(tables: Tables, checks: Sequence[Check], held: Held) -> list[DataFrame]:
    """All key checks, in one aggregation for each type of key."""
    by_type: dict[tuple[str, ...], dict[_Key, list]] = {}
    for (holder, columns), group in held_domains(checks, held).items():
        kinds = dict(tables[holder].dtypes)
        by_type.setdefault(tuple(kinds[c] for c in columns), {})[holder, columns] = group
    out, first = [], 0
    for domains in by_type.values():
        out.append(_domain_counts(tables, domains, first))
        first += len(domains)
    return out


def _keys(df: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """The key columns under common names; a key of one column that is missing is no key."""
    picked = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)], *more)
    return picked.filter(F.col("_k0").isNotNull()) if len(columns) == 1 else picked


def count_table(df: DataFrame, rows: Mapping[str, Column], columns: Sequence[str] = ()) -> tuple[dict[str, int], int]:
    """The aggregates ``rows`` and the number of repeated keys of a table, from one pass over it.

    The rows are counted on their way to the aggregation by key, which needs no shuffle where the table comes out
    of a join or an aggregation by that key.
    """
    counts = [count.alias(name) for name, count in rows.items()]
    if not columns:
        return (dict(df.agg(*counts).first().asDict()) if counts else {}), 0
    seen = Observation()
    by_key = _keys(df.observe(seen, *counts) if counts else df, columns).groupBy(*[f"_k{i}" for i in range(len(columns))])
    repeated = by_key.agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("n")).first()["n"]
    return (dict(seen.get) if counts else {}), repeated


def _count_domain(tables: Tables, key: _Key, checks: Sequence[Unique | Relationships]) -> dict[str, int]:
    """Failing rows of all checks about one key: how often it occurs, and how often under each child."""
    table, columns = key
    children = [c for c in checks if isinstance(c, Relationships)]
    if not children:
        _, repeated = count_table(tables[table], {}, columns)
        return {c.name: repeated for c in checks}
    sides = [(table, columns), *[(c.table, (c.column,)) for c in children]]
    rows = _union([_keys(tables[t], cs, F.lit(role).alias("_role")) for role, (t, cs) in enumerate(sides)])
    by_key = rows.groupBy("_k0").agg(*[F.count_if(F.col("_role") == r).alias(f"_n{r}") for r in range(len(sides))])
    orphans = [F.sum(F.when(F.col("_n0") == 0, F.col(f"_n{r}"))) for r in range(1, len(sides))]
    found = by_key.agg(F.count_if(F.col("_n0") > 1), *orphans).first()
    return {c.name: found[children.index(c) + 1 if c in children else 0] or 0 for c in checks}


def count_checks(
    tables: Tables, checks: Iterable[Check], counted: Mapping[str, int] | None = None, held: Held | None = None, at_once: int = 4
) -> dict[str, int]:
    """Failing rows of every check that is not ``counted`` yet, worked out now, ``at_once`` jobs at a time.

    Counts what ``run_checks`` counts. There one plan holds all shuffles of all checks at the same time, with room in
    each row for as many children as any key has.
    """
    open_checks = [c for c in checks if c.name not in (counted or {})]
    jobs: list[Callable[[], dict[str, int]]] = []
    for table, group in row_counts(open_checks).items():
        jobs.append(lambda table=table, group=group: count_table(tables[table], group)[0])
    jobs += [partial(_count_domain, tables, key, group) for key, group in held_domains(open_checks, held or {}).items()]
    for check in open_checks:
        if isinstance(check, RowsExpectedEmpty):
            jobs.append(lambda check=check: {check.name: check.count(tables).first()["failing_rows"]})
    with ThreadPoolExecutor(at_once) as pool:
        done = list(pool.map(lambda job: job(), jobs))
    return {name: n for found in done for name, n in found.items()}


def run_checks(
    tables: Tables, checks: Iterable[Check], counted: Mapping[str, int] | None = None, held: Held | None = None
) -> DataFrame:
    """``(check, table, status, failing_rows)`` for every check.

    ``counted`` holds the failing rows of row-level checks that were counted while their tables were written.
    ``held`` names, for a table that is read from another one, that other one and the columns it names otherwise:
    a key of both is counted once.
    """
    checks, counted = list(checks), counted or {}
    known = [(c.name, c.table, counted[c.name]) for c in checks if c.name in counted]
    open_checks = [c for c in checks if c.name not in counted]
    parts = [_row_check_counts(tables, table, group) for table, group in row_counts(open_checks).items()]
    parts += _key_check_counts(tables, open_checks, held or {})
    parts += [
        c.count(tables).select(F.lit(c.name).alias("check"), F.lit(c.table).alias("table"), "failing_rows")
        for c in open_checks
        if isinstance(c, RowsExpectedEmpty)
    ]
    if known:
        spark = SparkSession.active() if not parts else parts[0].sparkSession
        parts.append(spark.createDataFrame(known, "check string, `table` string, failing_rows long"))
    results = _union(parts)
    status = F.when(F.col("failing_rows") == 0, "pass").otherwise("fail")
    return results.select("check", "table", status.alias("status"), "failing_rows")


def summarize(results: DataFrame) -> DataFrame:
    """Number of checks per status."""
    return results.groupBy("status").agg(F.count("*").alias("checks"))


def check_grew(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many rows an informational query gave before and after, and whether it grew."""
    n_before = before.agg(F.count("*")).scalar()
    return after.agg(F.count("*").alias("after_count")).select(
        n_before.alias("before_count"), "after_count", (F.col("after_count") > n_before).alias("grew")
    )
