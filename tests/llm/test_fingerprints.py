import hashlib
import random

import pytest
import xxhash
from messy import empty, messy, messy_rows, words
from pyspark.sql import functions as F

from tallyworks.llm.fingerprints import compare_with_edits, fingerprint, near_fingerprints


def simhash(text):
    w, votes, total = words(text), [0] * 64, 0
    for i, a in enumerate(w):
        h = xxhash.xxh64_intdigest(a.encode(), seed=42)
        size = len(a.encode())
        if i + 1 < len(w):
            h = xxhash.xxh64_intdigest(w[i + 1].encode(), seed=h)
            size += len(w[i + 1].encode())
        total += min(size, 32)
        for b in range(64):
            votes[b] += min(size, 32) * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def test_compare_with_edits_equals_brute_force(spark):
    rows = {r[0]: r for r in messy_rows() if r[0] is not None}
    docs = messy(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    order = sorted(rows, reverse=True)
    got = {r.doc_id: r for r in compare_with_edits(docs).collect()}
    assert set(got) == set(order)
    for k, i in enumerate(order):
        own, following = rows[i][1] or "", rows[order[(k + 1) % len(order)]][1] or ""
        half = len(own) // 2
        edit = own[: len(own) - half] + following[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edit.encode()).hexdigest())
        assert r.fingerprint == f"{simhash(own):016x}"
        assert r.edited_fingerprint == f"{simhash(edit):016x}"
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if simhash(own) == simhash(following):
            assert r.near_next == 1


@pytest.mark.parametrize("radius", [0, 3, 12])
def test_the_search_counts_all_rows_within_the_radius(spark, radius):
    docs = messy(spark)
    got = compare_with_edits(docs, radius=radius, every=6).collect()
    prints = [int(r.fingerprint, 16) for r in got]
    for r in got:
        if r.doc_id is None or r.doc_id % 6:
            assert r.n_near is None
        else:
            assert r.n_near == sum((int(r.fingerprint, 16) ^ p).bit_count() <= radius for p in prints)


def test_next_document_across_buckets(spark):
    ids = [-5000, -1, 0, 2047, 2048, 9_000_000, 9_000_001, 1 << 40]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in compare_with_edits(docs).collect()}
    for k, i in enumerate(ids):
        own, following = f"text {i}", f"text {ids[k - 1]}"
        half = len(own) // 2
        assert got[i] == hashlib.sha256((own[: len(own) - half] + following[:half]).encode()).hexdigest()


def test_rows_with_null_ids_and_copies_stay(spark):
    assert compare_with_edits(messy(spark)).count() == len(messy_rows())
    assert compare_with_edits(empty(spark)).count() == 0


def test_equal_texts_have_equal_prints_and_edits_are_nearer_than_strangers(spark):
    out = compare_with_edits(messy(spark, seed=3)).filter("n_chars > 300")
    means = out.agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert means[0] > means[1] + 0.2
    prints = fingerprint(messy(spark).select("doc_id", "text", F.monotonically_increasing_id().alias("k")), ["k", "doc_id"])
    assert prints.filter("doc_id = 30").select("fingerprint").distinct().count() <= 1


@pytest.mark.parametrize("radius", [0, 1, 3, 8])
def test_block_tables_find_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:40]:
        for _ in range(4):
            w = v
            for b in rng.sample(range(64), rng.randrange(0, 11)):
                w ^= 1 << b
            values.append(w)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed + signed[:20]] + [(None,)], "fingerprint long")
    queries = spark.createDataFrame([(v,) for v in signed[::3]], "fingerprint long")
    got = [tuple(r) for r in near_fingerprints(prints, queries, radius).collect()]
    mask = (1 << 64) - 1
    wanted = {(a, b, ((a ^ b) & mask).bit_count()) for a in set(signed[::3]) for b in set(signed) if ((a ^ b) & mask).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == wanted
