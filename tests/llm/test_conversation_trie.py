import hashlib
import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tallyworks.llm.conversation_trie import rebuilt_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, hi long, total string"


def remainder(a, b):
    return abs(a) % b * (1 if a >= 0 else -1)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - remainder(c, 5), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, found in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(found) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    ends = defaultdict(list)
    for c, turns in rebuilt.items():
        ends[tuple(turns)].append(c)
    out = Counter()
    for p, found in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
        parent = min(members[p[:-1]]) if p else None
        out[min(found), len(p), parent, len(found), children[p], leaves[p], saved[p], digest] += 1
    return out


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in df.collect())


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)


def talk(seed, n=60, longest=9, words=2):
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        if rng.random() < 0.8:
            turns = rng.sample(range(-3, 1000), rng.randrange(1, longest + 1))
            rows += [(c, t, rng.choice(["user", "bot", None]), rng.choice(["", None, "é", *(f"t{i}" for i in range(words))])) for t in turns]
            if rng.random() < 0.2:
                rows.append((c, None, "system", "be nice"))
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("shard_rows", [4, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, shard_rows):
    rows = talk(seed)
    assert got(rebuilt_trie(table(spark, rows), shard_rows=shard_rows)) == brute(rows)


def test_copies_and_a_common_beginning_over_many_shards(spark):
    first = [("user", "hello"), ("bot", "yes?"), ("user", "why")]
    rows = [(c, t, *said) for c in range(100) for t, said in enumerate([*first, ("bot", f"b{c % 4}"), *[("user", f"u{c % 3}")] * (c % 3)])]
    assert got(rebuilt_trie(table(spark, rows), shard_rows=7)) == brute(rows)


@pytest.mark.parametrize(("stretch", "columns", "shard_rows"), [(4, 2, 6), (5, 16, 1000), (128, 16, 5)])
def test_long_conversations(spark, stretch, columns, shard_rows):
    rows = talk(5, n=25, longest=40, words=1)
    shared = [("user", f"s{i}") for i in range(37)]
    for c in (200, 201, 202, 203, 204, 206):
        rows += [(c, t, *said) for t, said in enumerate(shared[: 37 - c % 5 * 4] + [("bot", f"end {c % 2}")] * (c % 3))]
    assert got(rebuilt_trie(table(spark, rows), stretch=stretch, columns=columns, shard_rows=shard_rows)) == brute(rows)


def test_repeated_rows_and_partitions_agree(spark):
    rows = talk(3) * 2
    one, two = got(rebuilt_trie(table(spark, rows))), got(rebuilt_trie(table(spark, rows, 7)))
    assert one == two
    assert sum(k[3] for k in one if k[1] == 0) == len({r[0] for r in rows if r[0] is not None})


def test_empty_and_turnless(spark):
    assert rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = next(c for c in range(1, 99) if c % 5 and crc32(str(c).encode()) % 9 > 2)
    rows = [(alone, 0, "user", "hi")]
    assert got(rebuilt_trie(table(spark, rows))) == brute(rows)
    assert rebuilt_trie(table(spark, [(None, 1, "user", "x")])).filter(F.col("depth") >= 0).count() == 0
