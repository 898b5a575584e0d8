import random

import pytest
from messy import empty, messy, messy_rows, words

from tallyworks.llm.near_dedup import drop_near_duplicates, match_threshold, near_duplicates
from tallyworks.llm.shared import components


def shingles(text, n):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def brute(rows, n, percent):
    last = (1 << 63) - 1
    docs = [(last if r[0] is None else r[0], shingles(r[1], n)) for r in rows]
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(docs):
        for j, t in docs[:a]:
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted((i, len(s), root(i), root(i) == i) for i, s in docs)


def found(df):
    last = (1 << 63) - 1
    return sorted((last if r.doc_id is None else r.doc_id, r.n_shingles, last if r.component_id is None else r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80), (1, 100)])
def test_equals_brute_force(spark, n, percent):
    assert found(near_duplicates(messy(spark), shingle=n, percent=percent)) == brute(messy_rows(), n, percent)


def test_large_groups_are_cut_into_blocks_without_losing_links(spark):
    """A base, copies with few and with many edits, and chains whose ends are not alike."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 8, 14])):
            w[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w)))
    chain = list(base)
    for i in range(30):
        chain = chain[4:] + [f"c{i}_{k}" for k in range(4)]
        rows.append((2000 + i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(near_duplicates(docs, shingle=3, percent=85, block_shingles=1500)) == brute(rows, 3, 85)


def test_drop_keeps_one_of_each_group(spark):
    docs = messy(spark)
    kept = {r[0] for r in brute(messy_rows(), 5, 80) if r[3]}
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert {(1 << 63) - 1 if r.doc_id is None else r.doc_id for r in out.collect()} == kept


def test_threshold_and_empty_table(spark):
    assert 30 <= match_threshold(64, 0.8) < match_threshold(64, 0.85) < 50
    assert match_threshold(64, 1.0) == 64
    assert near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="percent"):
        near_duplicates(empty(spark), percent=0)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 200 + i) for i in range(1, 80)] + [(500, 500)] + [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if sum(root(y) == root(x) for y in parent) > 1}


def test_rows_without_an_id_or_with_one_id_are_told_apart_by_their_texts(spark):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(80)) for x in "abcde")
    rows = [(1, a), (None, a + " tail"), (None, b), (None, c), (None, c + " tail"), (None, c), (7, d), (7, e), (8, e + " tail"), (5, d + " tail"), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sorted((r.doc_id or 99, r.n_shingles, r.component_id or 99, r.kept) for r in near_duplicates(docs).collect() if r.n_shingles)
    kept_c = [x[3] for x in out if x[0] == 99 and x[2] == 99]
    assert [x for x in out if x[0] != 99] == [(1, 76, 1, True), (5, 77, 5, True), (7, 76, 5, False), (7, 76, 7, True), (8, 77, 7, False)]
    assert [x for x in out if x[0] == 99 and x[2] != 99] == [(99, 77, 1, False)] and len(kept_c) == 4 and sum(kept_c) in (2, 3)
    left = sorted((r.doc_id or 99, (r.text or "").removesuffix(" tail")) for r in drop_near_duplicates(docs).collect())
    assert left == sorted([(1, a), (5, d), (7, e), (99, b), (99, c), (99, ""), (99, "")])
