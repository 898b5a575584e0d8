import heapq
from collections import defaultdict

import numpy as np
import pytest
from messy import empty, messy, messy_rows, words
from pyspark.sql import functions as F

from tallyworks.llm import mixing
from tallyworks.llm.mixing import Line, apportion, mix_sources


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        parts = sum(weight[s] for s in order if s not in full) or 1
        above = {s for s in order if s not in full and rest * weight[s] / parts > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else rest * weight[s] / parts for s in order}
        full |= above


def highest_quotients(votes, most, seats):
    given = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if most[i]]
    heapq.heapify(heap)
    while seats and heap:
        _, i = heapq.heappop(heap)
        given[i] += 1
        seats -= 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def sizes_of(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    return sizes


def check(rows, got, block):
    sizes = sizes_of(rows)
    target = brute_targets(sizes)
    taken = defaultdict(int)
    assert sorted((str(r[0]), len(words(r[1]))) for r in rows) == sorted((str(g.doc_id), g["size"]) for g in got)
    for g in got:
        assert g.source_size == sizes[g.source] and g.target == pytest.approx(target[g.source])
        assert 0 <= g.taken <= 3 * g["size"]
        if g.spans is not None:
            assert sum((s.stop - s.first) * s.copies for s in g.spans) == g.taken
            assert all(0 <= s.first < s.stop <= g["size"] and 1 <= s.copies <= 3 for s in g.spans)
        taken[g.source] += g.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2 * block + sizes[s] / block, (s, taken[s], t)


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_caps_and_spans(spark, seed):
    rows = messy_rows(seed=seed)
    got = mix_sources(messy(spark, seed=seed)).collect()
    check(rows, got, mixing.BLOCK)


def test_reruns_and_partitions_agree(spark):
    one = sorted(map(str, mix_sources(messy(spark)).collect()))
    two = sorted(map(str, mix_sources(messy(spark).repartition(7)).collect()))
    assert one == two
    assert one != sorted(map(str, mix_sources(messy(spark), seed=8).collect()))


def test_many_shards_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 8)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    rows = messy_rows(n=90)
    got = mix_sources(messy(spark, n=90), block=10).collect()
    check(rows, got, 10)


def test_hot_source_and_small_ones(spark):
    rows = [(i, "word " * (i % 70 + 1), None, "hot" if i % 3 else f"s{i % 12}", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mix_sources(docs).collect()
    check(rows, got, mixing.BLOCK)
    assert len({g.target / g.source_size for g in got}) > 1


@pytest.mark.parametrize("case", range(12))
def test_apportion_equals_highest_quotients(spark, case):
    rng = np.random.default_rng(case)
    n = int(rng.integers(1, 40))
    votes = [float(v) for v in rng.choice([0.0, 0.4, 0.5, 1.5, 1.5, 7.25, 30.1, 200.0], n)]
    most = [int(m) for m in rng.integers(0, 60, n)] if case % 2 else [1000] * n
    seats = min(int(sum(votes) * rng.uniform(0.3, 1.2)), sum(m for m, v in zip(most, votes) if v))
    units = spark.createDataFrame(list(zip(range(n), votes, most)), "unit long, votes double, most long")
    got = [r["seats"] for r in apportion(units, "votes", "most", seats, "unit", "seats").orderBy("unit").collect()]
    assert got == highest_quotients(votes, most, seats)


def test_shards_get_highest_quotients():
    for blocks, quota in [(10, 7), (8192, 3000), (12289, 12288), (20000, 33333), (5, 15)]:
        line = Line(blocks * 31 + 3, blocks, quota, 2, 7)
        sizes = [line.shard_begin(s + 1) - line.shard_begin(s) for s in range(line.shards)]
        copies = [line.copies(s) for s in range(line.shards)]
        assert sum(sizes) == blocks and sum(c.sum() for c in copies) == quota
        extra = [int(c.sum()) - line.passes * n for c, n in zip(copies, sizes)]
        assert extra == highest_quotients(sizes, sizes, quota % blocks)
        edges = line.begin(np.arange(blocks + 1))
        assert edges[0] == 0 and edges[-1] == line.size and set(np.diff(edges)) <= {line.length, line.length + 1}
        some = np.arange(0, line.size, 17)
        assert (edges[line.block_at(some)] <= some).all() and (some < edges[line.block_at(some) + 1]).all()


def test_empty_table_and_texts(spark):
    assert mix_sources(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, None, "a"), (None, " ", None)], "doc_id long, text string, source string")
    got = mix_sources(docs).select("doc_id", "size", "target", F.col("taken")).collect()
    assert sorted(map(str, got)) == sorted(map(str, [(1, 0, 0.0, 0), (None, 0, 0.0, 0)])) or all(r.taken == 0 and r.target == 0.0 for r in got)
