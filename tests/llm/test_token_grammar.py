import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from messy import empty, messy, messy_rows
from tokenizers import Tokenizer

from tallyworks.llm import token_grammar
from tallyworks.llm.token_grammar import Shard, pack_shard, read_shards, read_tokens, repair, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("first", [300, 50257, 70000])
def test_shard_round_trip_and_random_access(first):
    rng = np.random.default_rng(first)
    phrases = [rng.integers(1, first, 12) for _ in range(8)]
    docs = [np.concatenate([phrases[i] for i in rng.integers(0, 8, rng.integers(1, 40))] + [np.zeros(1, np.int64)]) for _ in range(60)]
    ids = np.concatenate(docs).astype(np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    payload = pack_shard(ids, np.arange(60), offsets, first, 0)
    shard = Shard(payload)
    assert len(shard.grammar.rules) and len(shard.grammar.symbols) < len(ids) / 2 and len(payload) < 2 * len(ids)
    assert (shard.all_ids() == ids).all()
    for _ in range(100):
        start, n = int(rng.integers(0, len(ids))), int(rng.integers(0, 200))
        assert (shard.span(start, n) == ids[start : start + n]).all()


def test_rules_replace_frequent_pairs_and_never_the_end():
    ids = np.array(([5, 6] * 50 + [0]) * 4, dtype=np.uint32)
    grammar = repair(ids, 10, 0, least=4)
    assert (grammar.expand(grammar.symbols.astype(np.int64)) == ids).all()
    assert 0 not in grammar.rules
    same = repair(np.full(101, 7, dtype=np.uint32), 10, 0, least=4)
    assert (same.expand(same.symbols.astype(np.int64)) == 7).all()
    assert len(repair(np.zeros(0, np.uint32), 10, 0).symbols) == 0


@pytest.mark.parametrize("case", range(8))
def test_no_pair_is_left_twice(case):
    rng = np.random.default_rng(case)
    ids = rng.integers(0, [4, 10, 50, 3000][case % 4], 4000 if case < 4 else 60_000).astype(np.uint32)
    if case % 2:
        ids[2000:2900] = ids[:900]
    grammar = repair(ids, 60_000, 0)
    assert (grammar.expand(grammar.symbols) == ids).all()
    assert (grammar.size_of(grammar.symbols).sum()) == len(ids) and 0 not in grammar.rules
    left = Counter()
    symbols, last = grammar.symbols.tolist(), -2
    for i, pair in enumerate(zip(symbols[:-1], symbols[1:])):
        # of places that overlap (a a a) one counts
        if 0 in pair or (pair[0] == pair[1] and last == i - 1 and symbols[i - 1] == pair[0]):
            continue
        left[pair] += 1
        last = i
    assert max(left.values(), default=0) <= 1


def test_many_rules_take_wide_symbols():
    rng = np.random.default_rng(5)
    half = rng.integers(1, 50_000, 90_000)
    ids = np.concatenate([half, [0], rng.permutation(half.reshape(-1, 3)).ravel(), [0]]).astype(np.uint32)
    payload = pack_shard(ids, np.arange(2), np.array([0, 90_001, 180_002]), 50257, 0)
    shard = Shard(payload)
    assert 50257 + len(shard.grammar.rules) > 1 << 16
    assert (shard.all_ids() == ids).all() and (shard.span(90_500, 777) == ids[90_500:91_277]).all()
    assert len(payload) < 4 * len(ids)  # plain ids; nothing but the halves' triples repeats here


def test_files_give_back_every_document(spark, tmp_path):
    docs, path = messy(spark), str(tmp_path / "tokens")
    write_tokens(docs, path, PATH, shard_ids=2000)
    assert read_shards(spark, path).count() > 2
    library = Tokenizer.from_file(PATH)
    rows = sorted(messy_rows(), key=lambda r: (r[0] is None, r[0] or 0))
    at, wanted = 0, Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [0]
        wanted[r[0], at, len(ids), np.array(ids, dtype="<u4").tobytes()] += 1
        at += len(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in read_tokens(spark, path).collect()) == wanted


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    write_tokens(empty(spark), path, PATH)
    assert read_tokens(spark, path).count() == 0
    with pytest.raises(ValueError, match="not a token shard"):
        Shard(random.randbytes(100) + b"x")


@pytest.mark.parametrize("first", [50_257, 1 << 27])
def test_pairs_are_sorted_as_plain_numbers_where_they_fit(first, monkeypatch):
    rng = np.random.default_rng(first)
    ids = rng.integers(1, 300, 30_000).astype(np.uint32)
    ids[::100] = 0
    wanted = Counter(zip(ids[:-1].tolist(), ids[1:].tolist(), strict=True))
    if first < 1 << 20:
        for name in ("unique", "argsort"):
            monkeypatch.setattr(token_grammar.np, name, lambda *a, **k: pytest.fail("sorted by an index"))
    grammar = repair(ids, first, 0)
    assert (grammar.expand(grammar.symbols) == ids).all()
    monkeypatch.undo()
    width = first.bit_length()
    pairs, at, places, limit = token_grammar._often(*token_grammar._pairs(ids, None, 0, width), 2, width, 32)
    inside = {p: n for p, n in wanted.items() if 0 not in p}
    assert limit == max(2, max(inside.values()) // 32)
    got = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(pairs, np.bincount(at), strict=True)}
    assert got == {p: n for p, n in inside.items() if n >= limit} and (np.diff(places) > 0).all()
    assert all((int(ids[p]), int(ids[p + 1])) in got for p in places[:50])


def test_late_rounds_count_only_where_pairs_can_repeat(monkeypatch):
    rng = np.random.default_rng(11)
    ids = rng.integers(1, 50_000, 60_000).astype(np.uint32)
    for start in range(10_000, 50_000, 4_000):
        ids[start : start + 300] = ids[:300]
    counted, often = [], token_grammar._often
    monkeypatch.setattr(token_grammar, "_often", lambda keys, *a: counted.append(len(keys)) or often(keys, *a))
    grammar = repair(ids, 50_257, 0)
    assert (grammar.expand(grammar.symbols) == ids).all() and len(grammar.rules)
    symbols = grammar.symbols.tolist()
    assert max(Counter(zip(symbols[:-1], symbols[1:], strict=True)).values()) == 1
    assert counted[-1] < len(symbols) / 10
