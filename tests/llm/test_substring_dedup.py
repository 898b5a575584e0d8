import hashlib
from collections import Counter

import numpy as np
import pytest
from messy import empty, messy, messy_rows, words

from tallyworks.llm.substring_dedup import _Group, dedup_substrings, level_lengths


def brute(rows, window):
    last = 1 << 63
    first = {}
    for r in rows:
        w, key = words(r[1]), last if r[0] is None else r[0]
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            first[s] = min(key, first.get(s, key))
    out = Counter()
    for r in rows:
        w, key = words(r[1]), last if r[0] is None else r[0]
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key:
                gone.update(range(i, i + window))
        out[r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


def test_levels_double():
    assert level_lengths(13) == [7, 13]
    assert level_lengths(50) == [7, 13, 25, 50]
    assert level_lengths(5) == [5]


@pytest.mark.parametrize(("window", "group_bytes", "bucket"), [(13, 2000, 50), (13, 1 << 22, 1 << 20), (50, 2000, 50), (4, 2000, 50), (1, 5000, 50)])
def test_equals_brute_force(spark, window, group_bytes, bucket):
    out = dedup_substrings(messy(spark), window=window, keep_layout=False, group_bytes=group_bytes, bucket_entries=bucket)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in out.collect())
    assert got == brute(messy_rows(), window)


def test_keeps_layout_and_columns(spark):
    out = dedup_substrings(messy(spark))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "_row", "toxic", "n_words", "n_removed"]
    before = Counter((r[0], r[1]) for r in messy_rows())
    for r in out.collect():
        if not r.n_removed:
            assert before[r.doc_id, r.text]


def test_shared_passage_keeps_only_its_first_copy(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    docs = spark.createDataFrame([(i, f"head{i} {passage} tail{i}") for i in range(40)], "doc_id long, text string")
    out = {r.doc_id: r for r in dedup_substrings(docs, group_bytes=900).collect()}
    assert out[0].n_removed == 0
    assert all(out[i].text == f"head{i} tail{i}" and out[i].n_removed == 55 for i in range(1, 40))
    assert hashlib.sha256(out[1].text.encode()).hexdigest()


@pytest.mark.parametrize("window", [13, 50])
def test_groups_of_any_number_of_words(window):
    for n in range(2 * window + 1):
        text = " ".join(f"w{i % 3}" for i in range(n)).encode()
        for texts in ([text], [text, text], [None, text, b"one"]):
            group = _Group(np.arange(len(texts)), texts, level_lengths(window))
            for level in range(len(group.lengths)):
                distinct, _ = group.keys(level)
                group.settle(np.zeros(len(distinct), dtype=bool), level == len(group.lengths) - 1)
            repeats = int(group.alive.sum())
            assert repeats == (max(0, n - window + 1) if texts == [text, text] else 0)


def test_a_table_of_few_words(spark):
    docs = spark.createDataFrame([(1, "just three words"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in dedup_substrings(docs).collect()) == [(1, 3, 0), (2, 0, 0)]


def test_empty_table(spark):
    assert dedup_substrings(empty(spark)).count() == 0
