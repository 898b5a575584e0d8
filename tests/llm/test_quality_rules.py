import math
from collections import Counter

import numpy as np
import pytest
from messy import empty, messy, messy_rows, words
from pyspark.sql import functions as F

from tallyworks.llm.quality_rules import (
    FLOORS,
    _core,
    _starts,
    chi_square_cdf,
    chi_square_quantile,
    consistency,
    minimum_determinant,
    quality_rules,
    robust_estimates,
    text_statistics,
)


def brute(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(covered))


def test_statistics_equal_brute_force(spark):
    rows = messy_rows() + [(i, "a b c d e f g h " * i + "x", "en", "a", 1, "", "", 1, "") for i in range(1, 5)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    out = text_statistics(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in out) == Counter((r[0], *brute(r[1])) for r in rows)


def test_chi_square():
    assert chi_square_cdf(3.841458820694124, 1) == pytest.approx(0.95, abs=1e-9)
    assert chi_square_quantile(0.99, 5) == pytest.approx(15.08627246938899, abs=1e-6)
    assert consistency(0.999999, 5) == pytest.approx(1, abs=1e-3)


def concentrate(x, share=0.75, steps=5):
    """The same steps in numpy."""

    def estimate(rows, factor):
        return rows.mean(axis=0), np.maximum(np.cov(rows.T, bias=True) * factor, -1e9) + np.diag(np.square(FLOORS))

    mean, cov = estimate(x, 1.0)
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        bins = np.floor(np.log(d + 1e-3) * 16)
        order = np.sort(bins)
        last = order[math.ceil(len(x) * share) - 1]
        mean, cov = estimate(x[bins <= last], consistency(share, 5))
    return mean, cov


def test_estimates_equal_numpy_and_ignore_outliers(spark):
    rng = np.random.default_rng(0)
    x = rng.multivariate_normal(np.arange(5), np.diag([9, 4, 1, 0.5, 2]) + 0.3, 600)
    x[:120] += 40
    q = np.round(x * 1024).astype(int)
    rows = [("g", *map(int, r)) for r in q] + [("h", *map(int, r)) for r in q[200:320]]
    df = spark.createDataFrame(rows, "_group string, " + ", ".join(f"x{i} long" for i in range(5))).repartition(4)
    got = {r["_group"]: r for r in robust_estimates(df).collect()}
    for name, part in (("g", q), ("h", q[200:320])):
        mean, cov = concentrate(part / 1024)
        lower = np.linalg.cholesky(cov)
        assert [got[name][f"u{i}"] for i in range(5)] == pytest.approx(mean.tolist(), abs=1e-6)
        assert [got[name][f"l{i}_{j}"] for i in range(5) for j in range(i + 1)] == pytest.approx([lower[i, j] for i in range(5) for j in range(i + 1)], abs=1e-6)
    assert abs(got["g"]["u0"]) < 1


def test_junk_is_rejected_and_clean_texts_stay(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"word{rng.integers(0, 500)}" for _ in range(rng.integers(30, 400))), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(f"w{rng.integers(0, 500)}$$$ |" for _ in range(100)), "en", "s") for i in range(30)]
    rows += [(2000 + i, f"only {i} words", "en", "s") for i in range(10)]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[i].kept for i in range(300))
    assert not any(out[1000 + i].kept for i in range(30)) and not out[1000].base_failed
    assert all(out[2000 + i].base_failed and out[2000 + i].distance is None for i in range(10))


def test_small_groups_and_edges(spark):
    out = quality_rules(messy(spark))
    assert out.count() == len(messy_rows())
    assert out.filter("distance is not null").count() == 0  # too few rows for an estimate
    assert out.filter("kept = base_failed").count() == 0
    assert quality_rules(empty(spark)).count() == 0
    pooled = quality_rules(messy(spark), least_group=20).filter("not base_failed")
    assert pooled.filter(F.col("distance").isNull()).count() == 0


def ordinary(rng, n):
    return [f"word{rng.integers(0, 1000):03d}" for _ in range(n)]


def single_outliers(rng):
    """A text for each statistic that is far out in it and ordinary in the others."""
    passage = ordinary(rng, 25)
    return {
        "words": " ".join(ordinary(rng, 9000)),
        "characters a word": " ".join(w + "letters" for w in ordinary(rng, 200)),
        "symbols": " ".join("$#" + w[2:] for w in ordinary(rng, 200)),
        "repeated lines": "\n".join(f"word{rng.integers(0, 30):03d}" for _ in range(200)),
        "repeated words": " ".join(ordinary(rng, 75) + passage + ordinary(rng, 75) + passage),
    }


def test_an_outlier_in_any_single_statistic_is_rejected(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(ordinary(rng, int(rng.lognormal(5.3, 0.5)) + 20)), "en", "s") for i in range(400)]
    names = {1000 + i: (name, text) for i, (name, text) in enumerate(single_outliers(rng).items())}
    rows += [(i, text, "en", "s") for i, (_, text) in names.items()]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {name: (out[i].base_failed, out[i].kept) for i, (name, _) in names.items()} == {name: (False, False) for name, _ in names.values()}
    assert sum(out[i].kept for i in range(400)) >= 396


def test_copies_of_an_outlier_are_rejected_at_a_third_of_the_rows(spark):
    """Exact copies, near copies, and other outliers of the same source; and copies of an ordinary text cost no other text."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(ordinary(rng, int(rng.lognormal(5.3, 0.5)) + 20)), s) for s in "abc" for i in range(400)]
    others = [(1000 + i, text) for i, text in enumerate(single_outliers(rng).values())]
    rows += [(i, text, s) for s in "abc" for i, text in others]
    junk = ["$#" + w[2:] for w in ordinary(rng, 200)]
    rows += [(2000 + i, " ".join(junk), "a") for i in range(200)]
    rows += [(2000 + i, " ".join(junk[: 190 + i % 10] + ordinary(rng, 1)), "b") for i in range(200)]
    rows += [(2000 + i, rows[0][1], "c") for i in range(200)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, source string, lang string")
    out = [r for s in "abc" for r in quality_rules(docs.filter(F.col("source") == s)).withColumn("s", F.lit(s)).collect()]
    kept = {s: {r.doc_id for r in out if r.s == s and r.kept} for s in "abc"}
    assert not any(1000 <= i < 2000 for s in "abc" for i in kept[s])
    assert not any(i >= 2000 for s in "ab" for i in kept[s]) and sum(i >= 2000 for i in kept["c"]) == 200
    assert all(sum(i < 1000 for i in kept[s]) >= 392 for s in "abc")


def test_the_core_keeps_its_size_and_the_smallest_determinant_wins(spark):
    """A third of the rows lies apart, in a group of its own that steps from the plain mean and covariance keep."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 0.8, (1000, 5))
    x[:340] = 6 + rng.normal(0, 0.2, (340, 5))
    rows = [("g", *map(int, r)) for r in np.round(x * 1024).astype(int)] + [("h", *map(int, r)) for r in np.round(x[[0] * 90 + [400] * 91] * 1024).astype(int)]
    df = spark.createDataFrame(rows, "_group string, " + ", ".join(f"x{i} long" for i in range(5))).repartition(4)
    got = {r["_group"]: r for r in minimum_determinant(df).collect()}
    assert abs(robust_estimates(df.filter("_group = 'g'")).first().u0) > 0.5
    assert all(abs(got["g"][f"u{i}"]) < 0.3 and 0.6 < got["g"][f"l{i}_{i}"] < 1.2 for i in range(5))
    cores = _core(df, _starts(df), 0.5).collect()
    assert {(r["_group"], r["_start"]): r["n"] for r in cores} == {(g, s): n for g, n in (("g", 500), ("h", 91)) for s in range(5)}
