"""Quality rules and robust multivariate outliers, with DataFrame functions only.

Base rules look at each text alone. On top, each language and source has a robust picture of its
documents: the minimum covariance determinant estimate over transformed statistics, found by
concentration steps from several starts. A step measures every document's Mahalanobis distance under
the current mean and covariance, keeps the half with the smallest distances, and takes mean and
covariance of those. Of all starts the one whose covariance has the smallest determinant is chosen, and
estimated once more from all documents near it. A document whose distance under that is beyond a
chi-square quantile is rejected.

A step is one pass for all starts: distances are put into narrow logarithmic bins, moments are summed
by group, start and bin before the shuffle, and the bins that make up the half are added up, the last
one by the part of it that is still missing. Sums are of whole numbers, so the outcome does not depend
on their order. Whatever a source's size, a task sees its bins only. Documents with equal statistics
are one row of the estimate: copies say nothing new about a source, and a third of a core that has no
spread would make everything else look far away.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.fingerprints import word_array
from tallyworks.llm.shared import rule_column, scratch
from tallyworks.operators.joins import join_hot

SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 8
SHARE = 0.75
CORE = 0.5
STEPS = 5
#: Starts of the concentration besides the plain and the median one: rows of each group, by hash.
ROW_STARTS = 3
#: Rows up to this chi-square quantile from the chosen core make the final estimate.
NEAR = 0.975
CERTAINTY = 0.999
LEAST_GROUP = 100
UNIT = 1024
BINS_PER_E = 16
#: Spread of each statistic that says nothing about a text: log of words, characters a word, and logs of
#: symbols, repeated lines and repeated words for every thousand. Sized by the measurement: what one symbol,
#: line or passage does to a text of ordinary length. Each statistic alone can reach the limit.
FLOORS = (0.6, 0.4, 0.5, 0.6, 1.0)
DIMENSIONS = len(FLOORS)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long); a null text has none of anything."""
    n = F.size("_w")
    hashes = F.when(
        n >= REPEAT_WINDOW,
        F.transform(F.sequence(F.lit(1), F.greatest(n - (REPEAT_WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("_w", i, REPEAT_WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    made = docs.withColumn("_w", word_array(F.col(text))).withColumn("_h", hashes).withColumn("_l", lines)
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    made = made.withColumn("_s", F.when(repeats, F.array_sort(F.arrays_zip(F.col("_h").alias("h"), F.sequence(F.lit(0), F.size("_h") - 1).alias("i")))))
    size = F.size("_s")
    made = made.withColumn("_k", F.col("_s.h")).withColumn("_i", F.col("_s.i"))
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice("_k", F.lit(1), size - 1))
    behind = F.slice("_k", F.lit(2), size - 1)
    beside = F.arrays_zip(F.col("_k").alias("k"), F.col("_i").alias("i"), before.alias("b"), behind.alias("a"))
    twice = F.filter(beside, lambda x: (x["k"] == x["b"]).eqNullSafe(True) | (x["k"] == x["a"]).eqNullSafe(True))
    made = made.withColumn("_p", F.when(repeats, F.sort_array(twice["i"])))
    gaps = F.zip_with(F.slice("_p", F.lit(2), F.size("_p") - 1), F.slice("_p", F.lit(1), F.size("_p") - 1), lambda b, a: F.least(b - a, F.lit(REPEAT_WINDOW)))
    covered = F.when(F.size("_p") > 0, F.aggregate(gaps, F.lit(REPEAT_WINDOW), lambda total, gap: total + gap)).otherwise(0)
    figures = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join("_w", "")),
        "n_symbols": F.coalesce(F.regexp_count(F.col(text), F.lit(SYMBOLS)), F.lit(0)),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": covered,
    }
    kept = [c for c in docs.columns if c not in figures]
    return made.select(*kept, *[v.cast("long").alias(k) for k, v in figures.items()])


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def statistic_vector() -> list[Column]:
    """The transformed statistics in units of 1/1024."""
    words = F.greatest("n_words", F.lit(1))

    def rate(name: str, by: Column) -> Column:
        return F.log1p(1000.0 * F.col(name) / by)

    values = [
        F.log1p(F.col("n_words").cast("double")),
        F.least(F.col("word_chars") / words, F.lit(64.0)),
        rate("n_symbols", F.greatest("word_chars", F.lit(1))),
        rate("n_dup_lines", words),
        rate("n_repeat_words", words),
    ]
    return [F.round(v * UNIT).cast("long") for v in values]


def chi_square_cdf(x: float, k: int) -> float:
    """By the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-15:
        n += 1
        term *= half / (a + n)
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, k) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, k) < p else (low, middle)
    return (low + high) / 2


def consistency(share: float, k: int) -> float:
    """What the covariance of the closest ``share`` of normal rows is multiplied with to estimate that of all."""
    return share / chi_square_cdf(chi_square_quantile(share, k), k + 2)


_NAMES = [*[f"m{i}" for i in range(DIMENSIONS)], *[f"m{i}_{j}" for i in range(DIMENSIONS) for j in range(i + 1)]]
_PARTS = [*[f"u{i}" for i in range(DIMENSIONS)], *[f"l{i}_{j}" for i in range(DIMENSIONS) for j in range(i + 1)]]


def _moments() -> list[Column]:
    sums = [F.sum(f"x{i}").alias(f"m{i}") for i in range(DIMENSIONS)]
    return sums + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"m{i}_{j}") for i in range(DIMENSIONS) for j in range(i + 1)]


def _estimate(moments: DataFrame, keys: list[str], factor: float, added: bool = False) -> DataFrame:
    """Mean ``u`` and the lower triangle ``l`` whose square is the covariance, by ``keys``, from summed moments.

    A variance is at least the square of the statistic's floor, or has that ``added``, so the covariance never is singular.
    """
    n = F.col("n").cast("double")
    frame = moments.select(
        *keys,
        *[(F.col(f"m{i}") / n / UNIT).alias(f"u{i}") for i in range(DIMENSIONS)],
        *[(F.col(f"m{i}_{j}") / n / UNIT**2).alias(f"c{i}_{j}") for i in range(DIMENSIONS) for j in range(i + 1)],
    )
    for i in range(DIMENSIONS):
        for j in range(i + 1):
            covariance = (F.col(f"c{i}_{j}") - F.col(f"u{i}") * F.col(f"u{j}")) * factor
            if i == j:
                covariance = F.greatest(covariance, F.lit(0.0)) + FLOORS[i] ** 2 if added else F.greatest(covariance, F.lit(FLOORS[i] ** 2))
            for k in range(j):
                covariance = covariance - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            entry = F.sqrt(F.greatest(covariance, F.lit(1e-6))) if i == j else covariance / F.col(f"l{j}_{j}")
            frame = frame.withColumn(f"l{i}_{j}", entry)
    return frame.select(*keys, *_PARTS)


def _distance(rows: DataFrame) -> DataFrame:
    """``rows`` (vector and estimate side by side) with ``d2``, the squared Mahalanobis distance."""
    for i in range(DIMENSIONS):
        rest = F.col(f"x{i}") / UNIT - F.col(f"u{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}_{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    total = F.col("y0") * F.col("y0")
    for i in range(1, DIMENSIONS):
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return rows.withColumn("d2", total)


def _concentrate(vectors: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    """Moments of the share of each group's rows with the smallest distances; rows in the last bin all count."""
    near = _distance(join_hot(vectors, estimate, "_group")).withColumn("_bin", F.floor(F.log(F.col("d2") + 1e-3) * BINS_PER_E))
    binned = near.groupBy("_group", "_bin").agg(F.count("*").alias("n"), *_moments())
    upto = Window.partitionBy("_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    placed = binned.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("_total", F.sum("n").over(whole))
    chosen = placed.filter(F.col("_before") < F.ceil(F.col("_total") * share))
    return chosen.groupBy("_group").agg(*[F.sum(c).alias(c) for c in ("n", *_NAMES)])


def robust_estimates(vectors: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Concentration steps from one start, the plain mean and covariance, for each ``_group`` of ``vectors``.

    ``vectors`` have ``x0`` and on, in units of 1/1024. Good against few outliers; see ``minimum_determinant``.
    """
    first = vectors.groupBy("_group").agg(F.count("*").alias("n"), *_moments())
    estimate = scratch(_estimate(first, ["_group"], 1.0, added=True))
    for _ in range(steps):
        estimate = scratch(_estimate(_concentrate(vectors, estimate, share), ["_group"], consistency(share, DIMENSIONS), added=True))
    return estimate


def _starts(vectors: DataFrame) -> DataFrame:
    """Where the concentration of each group starts: ``_group, _start`` and an estimate.

    The plain mean and covariance; the medians; and some of its rows. All but the first have the shorter
    of the two middle quarters of each statistic as its spread.
    """
    quarters = [F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(DIMENSIONS)]
    vector = F.struct(*[f"x{i}" for i in range(DIMENSIONS)])
    drawn = [F.min_by(vector, F.struct(F.xxhash64(F.lit(k), vector), vector)).alias(f"r{k}") for k in range(ROW_STARTS)]
    made = scratch(vectors.groupBy("_group").agg(F.count("*").alias("n"), *_moments(), *quarters, *drawn))
    spreads = []
    for i in range(DIMENSIONS):
        q = F.col(f"q{i}")
        spreads.append(F.greatest(F.least(q[2] - q[1], q[1] - q[0]) / UNIT / 0.6745, F.lit(FLOORS[i])))
    triangle = [(spreads[i] if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i in range(DIMENSIONS) for j in range(i + 1)]
    out = _estimate(made, ["_group"], 1.0, added=True).withColumn("_start", F.lit(0))
    middles = [[F.col(f"q{i}")[1] for i in range(DIMENSIONS)], *[[F.col(f"r{k}")[f"x{i}"] for i in range(DIMENSIONS)] for k in range(ROW_STARTS)]]
    for start, middle in enumerate(middles, 1):
        means = [(m / UNIT).cast("double").alias(f"u{i}") for i, m in enumerate(middle)]
        out = out.unionByName(made.select("_group", *means, *triangle, F.lit(start).alias("_start")))
    return out


def _core(vectors: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """Moments of the share of each group's rows with the smallest distances, by start; the last bin counts by the part that is missing."""
    near = _distance(join_hot(vectors, estimates, "_group")).withColumn("_bin", F.floor(F.log(F.col("d2") + 1e-3) * BINS_PER_E))
    binned = near.groupBy("_group", "_start", "_bin").agg(F.count("*").alias("n"), *_moments())
    upto = Window.partitionBy("_group", "_start").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group", "_start")
    placed = binned.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("_size", F.ceil(F.sum("n").over(whole) * share))
    chosen = placed.filter(F.col("_before") < F.col("_size")).withColumn("_rest", F.col("_size") - F.col("_before"))
    inside = F.col("n") <= F.col("_rest")

    def total(name: str) -> Column:
        part = F.sum(F.when(~inside, F.col(name) * (F.col("_rest") / F.col("n"))))
        return (F.coalesce(F.sum(F.when(inside, F.col(name))), F.lit(0)) + F.coalesce(part, F.lit(0.0))).alias(name)

    return chosen.groupBy("_group", "_start").agg(*[total(c) for c in ("n", *_NAMES)])


def minimum_determinant(vectors: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Minimum covariance determinant estimate of each ``_group`` of ``vectors`` (``x0`` and on, in units of 1/1024).

    Equal vectors of a group count once. Cores have the floors added, which bounds their spread in every
    direction: a tight group far away does not win by its small spread across the way to it. The best
    core's estimate is renewed from all rows near it, with the floors as the least spread.
    """
    distinct = scratch(vectors.select("_group", *[f"x{i}" for i in range(DIMENSIONS)]).distinct())
    estimates = scratch(_starts(distinct))
    for _ in range(steps):
        estimates = scratch(_estimate(_core(distinct, estimates, core), ["_group", "_start"], consistency(core, DIMENSIONS), added=True))
    determinant = F.lit(1.0)
    for i in range(DIMENSIONS):
        determinant = determinant * F.col(f"l{i}_{i}") * F.col(f"l{i}_{i}")
    best = estimates.groupBy("_group").agg(F.min_by(F.struct(*_PARTS), F.struct(determinant, "_start")).alias("e")).select("_group", "e.*")
    near = _distance(join_hot(distinct, best, "_group")).filter(F.col("d2") <= chi_square_quantile(NEAR, DIMENSIONS))
    return scratch(_estimate(near.groupBy("_group").agg(F.count("*").alias("n"), *_moments()), ["_group"], consistency(NEAR, DIMENSIONS)))


def _grouped(rows: DataFrame, lang: str, source: str, least: int) -> DataFrame:
    """``rows`` with ``_group``: language and source if they have enough rows, else the language, else all of those."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    by_source = F.concat_ws("\u0001", F.lit("s"), known(lang), known(source))
    counted = rows.withColumn("_fine", by_source).withColumn("_lang", known(lang))
    fine = counted.groupBy("_fine", "_lang").agg(F.count("*").alias("_n"))
    small = fine.filter(F.col("_n") < least)
    coarse = small.groupBy("_lang").agg(F.sum("_n").alias("_few"))
    named = fine.join(coarse, "_lang", "left").select(
        "_fine",
        F.when(F.col("_n") >= least, F.col("_fine"))
        .when(F.col("_few") >= least, F.concat_ws("\u0001", F.lit("l"), "_lang"))
        .otherwise(F.lit("a"))
        .alias("_group"),
    )
    return join_hot(counted, named, "_fine").drop("_fine", "_lang")


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    share: float = CORE,
    steps: int = STEPS,
    certainty: float = CERTAINTY,
    least_group: int = LEAST_GROUP,
) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``distance`` and ``kept`` of each row.

    Estimates are made from the documents that pass the base rules, all of them. Groups of fewer than
    ``least_group`` are put together by language, and those by themselves where still too few; if even
    these are fewer, nothing is rejected on their account. ``distance`` is the squared Mahalanobis
    distance, null for documents that fail the base rules or have no estimate. Null texts have no words
    and fail; a missing language or source is a group of its own. Documents with equal statistics count
    once in the estimates, and each is judged. An empty table gives an empty table; other columns are left out.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    figures = text_statistics(own, "text").drop("text").withColumn("base_failed", base_failed())
    figures = scratch(figures.select("*", *[v.alias(f"x{i}") for i, v in enumerate(statistic_vector())]))
    passed = scratch(_grouped(figures.filter(~F.col("base_failed")), "lang", "source", least_group))
    estimates = minimum_determinant(passed, share, steps)
    enough = passed.groupBy("_group").agg((F.count("*") >= least_group).alias("_enough"))
    judged = _distance(join_hot(passed, estimates.join(enough, "_group"), "_group"))
    beyond = chi_square_quantile(certainty, DIMENSIONS)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    good = judged.select(*columns, F.when(F.col("_enough"), F.col("d2")).alias("distance"))
    failed = figures.filter("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"))
    return good.unionByName(failed).withColumn("kept", ~F.col("base_failed") & ~rule_column(F.col("distance") > beyond))
