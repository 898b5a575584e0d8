import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from messy import SCHEMA, empty, messy, messy_rows

from tallyworks.llm.importance import after_byte, resample, shifted, text_features

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute_features(text, longest):
    w = brute_words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent=25, buckets=10_000, longest=2):
    found = [[crc32(f.encode()) % buckets for f in brute_features(r[1], longest)] for r in rows]
    s = Counter(b for f in found for b in f)
    t = Counter(crc32(f.encode()) % buckets for x in target for f in brute_features(x, longest))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for r, f in zip(rows, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(f), weight, score, None, len(brute_words(r[1])) >= 20])
    fit = sorted((o for o in out if o[5]), key=lambda o: (-o[3], math.inf if o[0] is None else o[0]))
    for i, o in enumerate(fit[: percent * len(fit) // 100]):
        o[4] = i + 1
    return Counter(tuple(o[:5]) for o in out)


def got(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


TARGET = ["w1 w2 w3 Spam w17 w18", None, "", "日本 ünï w5 w6 one two words", "w1 w2 w3"]


def targets(spark, texts=TARGET):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_substring_crcs_equal_plain_ones(longest):
    texts = [r[1] for r in messy_rows()] + ["a" * 70_000 + " b", "x", "\x00\x7f", "É É É"]
    counts, sizes, crcs = text_features([t.encode() if t is not None else None for t in texts], longest)
    assert counts.tolist() == [len(brute_words(t)) for t in texts]
    want = [[crc32(f.encode()) for f in brute_features(t, longest)] for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert crcs.tolist() == [c for w in want for c in w]


def test_shift_and_byte_step():
    rng = np.random.default_rng(1)
    heads = [rng.bytes(int(n)) for n in rng.integers(0, 50, 200)]
    tails = [rng.bytes(int(n)) for n in rng.integers(0, 3000, 200)]
    head = np.array([crc32(h) for h in heads], dtype=np.uint32)
    moved = shifted(head, np.array([len(t) for t in tails]))
    assert (moved ^ np.array([crc32(t) for t in tails], dtype=np.uint32)).tolist() == [crc32(h + t) for h, t in zip(heads, tails)]
    assert after_byte(head, 65).tolist() == [crc32(h + b"A") for h in heads]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    assert got(resample(messy(spark, seed=seed), targets(spark))) == brute(messy_rows(seed=seed), TARGET)


def test_more_of_everything(spark):
    out = resample(messy(spark), targets(spark), percent=100, buckets=70_000, longest=3)
    assert got(out) == brute(messy_rows(), TARGET, 100, 70_000, 3)


def test_ties_and_equal_rows_take_ranks_in_turn(spark):
    rows = [(i // 2, "one two " * 20, "en", "a", 0, None, None, None, None) for i in range(40)]
    out = resample(spark.createDataFrame(rows, SCHEMA).repartition(5), targets(spark), percent=50)
    assert got(out) == brute(rows, TARGET, 50)
    assert sorted(r["rank"] for r in out.collect() if r["rank"]) == list(range(1, 21))


def test_empty_tables(spark):
    assert resample(empty(spark), targets(spark)).count() == 0
    assert got(resample(messy(spark), targets(spark, []))) == brute(messy_rows(), [])
    lone = [(1, None, "en", "a", 0, None, None, None, None)]
    assert got(resample(spark.createDataFrame(lone, SCHEMA), targets(spark))) == brute(lone, TARGET)


def test_the_draw_leans_to_the_target(spark):
    rows = [(i, " ".join(f"{'math' if i % 4 == 0 else 'news'}{(i * j) % 50}" for j in range(40)), "en", "a", 0, None, None, None, None) for i in range(1, 400)]
    aim = [" ".join(f"math{j % 50}" for j in range(200))]
    drawn = {r.doc_id for r in resample(spark.createDataFrame(rows, SCHEMA), targets(spark, aim)).collect() if r["rank"]}
    assert len(drawn) == 399 // 4 and sum(d % 4 == 0 for d in drawn) > 0.4 * len(drawn)  # a quarter without weights
