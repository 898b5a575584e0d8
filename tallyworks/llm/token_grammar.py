"""Token shards compressed by Re-Pair: frequent pairs of ids become nonterminals, over and over.

Documents are dealt by ascending id into ranges, each range into shards of bounded size. In a shard,
pairs of neighbours that occur often get a nonterminal each and are replaced from left to right, the
most frequent first, until no pair occurs twice. A shard holds the rules, how many ids each
rule stands for, the remaining symbols, and the place in the ids of every 1,024th symbol, so that any
span of ids is decoded from the symbols that cover it, and the rules these reach, alone.

A shard is one binary value, so Spark's own writer commits it, and a task that runs twice leaves one
copy. Layout, all little-endian: magic ``RPG2``; eight unsigned 64-bit numbers (documents, ids,
rules, symbols, first nonterminal, bits a symbol, marks, end id); document ids (signed 64); document
starts and the end (unsigned 64); marks (unsigned 64); left and right sides of the rules; expansion
lengths (unsigned 32); symbols. Rule sides and symbols are an array of their low 16 bits (unsigned 16) and
one packed array of bits for each further bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import LAST_ID, pieces_for, running_total, ship, text_size
from tallyworks.llm.token_ids import encoded, filled_ids

MAGIC = b"RPG2"
MARK_EVERY = 1024
SHARD_IDS = 1 << 20
RANGE_BYTES = 16 << 20
LEAST_COUNT = 2
SHARD_SCHEMA = "shard long, documents long, ids long, payload binary"


@dataclass
class Grammar:
    """``symbols`` below ``first`` are ids; ``first + i`` stands for the two symbols of rule i."""

    symbols: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    first: int

    def size_of(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self.first
        out[rule] = self.lengths[symbols[rule] - self.first]
        return out

    @cached_property
    def left_sizes(self) -> np.ndarray:
        """How many ids the left side of each rule stands for."""
        return self.size_of(self.rules[:, 0])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids behind ``symbols``. Lengths tell where each side of a rule goes; only rules that are reached are opened."""
        now = np.asarray(symbols).astype(np.uint32)
        size = self.size_of(now)
        at = np.cumsum(size) - size
        out = np.empty(int(size.sum()), dtype=np.uint32)
        while len(now):
            out[at] = now  # where a rule begins, so does its left side, which the next turn writes over it
            opened = np.flatnonzero(now >= self.first)
            rule, at = now[opened] - np.uint32(self.first), at[opened]
            left, right = self.rules[rule].T
            now, at = np.concatenate([left, right], dtype=np.uint32, casting="unsafe"), np.concatenate([at, at + self.left_sizes[rule]])
        return out


def repair(ids: np.ndarray, first: int, end_id: int, least: int = LEAST_COUNT) -> Grammar:
    """Re-Pair over one shard. ``first`` is above every id; pairs with ``end_id`` stay, so no rule spans documents.

    A full round counts all pairs and takes those that occur at least a thirty-second as often as the most frequent
    one (never under ``least``); pairs that share a neighbour are settled from the left. What it makes frequent
    are pairs with a new nonterminal, all of which lie where it replaced something, so the rounds after it count
    there alone until nothing is left. Once a full round has gone down to ``least``, pairs that occur so often are
    those it found or have a newer nonterminal, so the full rounds after it count at the places of both, not at all.
    It ends with a full round that finds no pair ``least`` times, but for places that overlap (a a a).
    """
    now = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    to_the_end, open_places = False, None
    while True:
        width = (first + sum(map(len, rules))).bit_length()
        pairs, at, places, limit = _often(*_pairs(now, open_places, end_id, width), least, width, 0 if to_the_end else 32)
        still = None
        if limit == least:
            still = np.zeros(len(now), dtype=bool)
            still[places] = True
        now, made, still = _rounds(now, pairs, at, places, limit, first, end_id, rules, still)
        if not made and limit == least:
            now, made, still = _rounds(now, *_apart(pairs, at, places), limit, first, end_id, rules, still)
            if not made:
                return _grammar(now, rules, first)
        to_the_end, open_places = not made, None if still is None else np.flatnonzero(still[:-1])


def _pairs(now: np.ndarray, places: np.ndarray | None, end_id: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair that begins at each of the places (all, if they are not given) as one number, without those of the end.

    Symbols have ``width`` bits.
    """
    left, right = (now[:-1], now[1:]) if places is None else (now[places], now[places + 1])
    inside = (left != end_id) & (right != end_id)
    places = np.flatnonzero(inside) if places is None else places[inside]
    return (left[inside].astype(np.uint64) << np.uint64(width)) | right[inside], places


def _often(keys: np.ndarray, places: np.ndarray, limit: int, width: int, part: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs that occur ``limit`` times, which of them is at which place, and the limit.

    With ``part``, pairs must also occur that part as often as the most frequent one. Places ascend. Pair and place
    are sorted as one number, as plain numbers are sorted several times as fast as indices to them.
    """
    if not len(keys):
        return keys, places, places, limit
    low = int(places[-1]).bit_length()
    if 2 * width + low > 64:
        pairs, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
        limit = max(limit, int(counts.max()) // part) if part else limit
        return *_picked(_wide(pairs, width), at, places, counts >= limit), limit
    both = np.sort((keys << np.uint64(low)) | places.astype(np.uint64))
    starts = np.concatenate([[0], np.flatnonzero((both[1:] ^ both[:-1]) >> np.uint64(low)) + 1])
    counts = np.diff(starts, append=len(both))
    limit = max(limit, int(counts.max()) // part) if part else limit
    good = counts >= limit
    pairs, counts = both[starts[good]] >> np.uint64(low), counts[good]
    if not len(pairs):
        return pairs, places[:0], places[:0], limit
    runs = np.repeat(starts[good] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    found = both[runs] & np.uint64((1 << low) - 1)
    high = len(pairs).bit_length()
    if low + high > 64:
        order = np.argsort(found)
        return _wide(pairs, width), np.repeat(np.arange(len(pairs)), counts)[order], found[order].astype(np.int64), limit
    found = np.sort((found << np.uint64(high)) | np.repeat(np.arange(len(pairs), dtype=np.uint64), counts))
    return _wide(pairs, width), (found & np.uint64((1 << high) - 1)).astype(np.int64), (found >> np.uint64(high)).astype(np.int64), limit


def _wide(pairs: np.ndarray, width: int) -> np.ndarray:
    """The left symbol in the high 32 bits and the right one in the low 32."""
    return (pairs >> np.uint64(width) << np.uint64(32)) | (pairs & np.uint64((1 << width) - 1))


def _picked(pairs: np.ndarray, at: np.ndarray, places: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some = np.flatnonzero(good[at])
    return pairs[good], (np.cumsum(good) - 1)[at[some]], places[some]


def _rounds(
    now: np.ndarray,
    pairs: np.ndarray,
    at: np.ndarray,
    places: np.ndarray,
    limit: int,
    first: int,
    end_id: int,
    rules: list[np.ndarray],
    still: np.ndarray | None,
) -> tuple[np.ndarray, int, np.ndarray | None]:
    """Replace ``pairs``, then what that makes frequent, until nothing is; new rules go to ``rules``.

    ``still``, if given, marks places of ``now`` to count at later; those of new nonterminals join them.
    """
    made, base = 0, first + sum(map(len, rules))
    while len(pairs):
        chosen = np.flatnonzero(_from_the_left(places))
        places, at = places[chosen], at[chosen]
        pairs, at, places = _picked(pairs, at, places, np.bincount(at, minlength=len(pairs)) >= 2)
        if not len(pairs):
            break
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64((1 << 32) - 1)], axis=1).astype(np.int64))
        now[places] = base + at
        base, made = base + len(pairs), made + len(pairs)
        stays = np.ones(len(now), dtype=bool)
        stays[places + 1] = False
        now = now[stays]
        moved = places - np.arange(len(places))
        near = np.empty(2 * len(moved), dtype=np.int64)
        near[0::2], near[1::2] = moved - 1, moved
        near = near[np.concatenate([[True], near[1:] > np.maximum.accumulate(near)[:-1]])]
        near = near[(near >= 0) & (near < len(now) - 1)]
        if still is not None:
            still = still[stays]
            still[near] = True
        width = base.bit_length()
        pairs, at, places, _ = _often(*_pairs(now, near, end_id, width), limit, width)
    return now, made, still


def _apart(pairs: np.ndarray, at: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Only pairs of which no two share a symbol, so that none is in another's way; pairs of two symbols come first."""
    seen: set[int] = set()
    good = np.zeros(len(pairs), dtype=bool)
    for i in sorted(range(len(pairs)), key=lambda i: int(pairs[i]) >> 32 == int(pairs[i]) & 0xFFFFFFFF):
        sides = {int(pairs[i]) >> 32, int(pairs[i]) & 0xFFFFFFFF}
        if not sides & seen:
            seen |= sides
            good[i] = True
    return _picked(pairs, at, places, good)


def _grammar(now: np.ndarray, rules: list[np.ndarray], first: int) -> Grammar:
    """Rules in order with their lengths; a rule's sides were made before it, a batch at a time."""
    lengths = np.ones(first + sum(map(len, rules)), dtype=np.int64)
    at = first
    for batch in rules:
        lengths[at : at + len(batch)] = lengths[batch].sum(axis=1)
        at += len(batch)
    every = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    return Grammar(now.astype(np.int64), every, lengths[first:], first)


def _from_the_left(places: np.ndarray) -> np.ndarray:
    """Which places to replace: in each run of places that overlap their neighbours, every second one."""
    if not len(places):
        return np.zeros(0, dtype=bool)
    starts = np.ones(len(places), dtype=bool)
    starts[1:] = np.diff(places) != 1
    run = places[starts][np.cumsum(starts) - 1]
    return (places - run) % 2 == 0


def _packed(values: np.ndarray, bits: int) -> list[bytes]:
    parts = [(values & 0xFFFF).astype("<u2").tobytes()]
    return parts + [np.packbits((values >> b) & 1 == 1).tobytes() for b in range(16, bits)]


def pack_shard(ids: np.ndarray, docs: np.ndarray, offsets: np.ndarray, first: int, end_id: int) -> bytes:
    grammar = repair(ids, first, end_id)
    upto = np.concatenate([[0], np.cumsum(grammar.size_of(grammar.symbols))])
    marks = upto[:-1][::MARK_EVERY]
    bits = max(16, int(first + len(grammar.rules)).bit_length())
    head = np.array([len(docs), len(ids), len(grammar.rules), len(grammar.symbols), first, bits, len(marks), end_id], dtype="<u8")
    parts = [p.tobytes() for p in (head, docs.astype("<i8"), offsets.astype("<u8"), marks.astype("<u8"))]
    for side in (0, 1):
        parts += _packed(grammar.rules[:, side], bits)
    return b"".join([MAGIC, *parts, grammar.lengths.astype("<u4").tobytes(), *_packed(grammar.symbols, bits)])


class Shard:
    """Reads one shard; nothing is expanded before it is asked for."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token shard")
        at = 4

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        def packed(n: int, bits: int) -> np.ndarray:
            out = take("<u2", n).astype(np.int64)
            for bit in range(16, bits):
                out |= np.unpackbits(take("u1", -(-n // 8)), count=n).astype(np.int64) << bit
            return out

        n_docs, self.n_ids, n_rules, n_symbols, first, bits, n_marks, _ = (int(x) for x in take("<u8", 8))
        self.docs, self.offsets = take("<i8", n_docs), take("<u8", n_docs + 1).astype(np.int64)
        self.marks = take("<u8", n_marks).astype(np.int64)
        rules = np.stack([packed(n_rules, bits), packed(n_rules, bits)], axis=1)
        lengths = take("<u4", n_rules).astype(np.int64)
        self.grammar = Grammar(packed(n_symbols, bits), rules, lengths, first)

    def all_ids(self) -> np.ndarray:
        return self.grammar.expand(self.grammar.symbols)

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on, from the symbols between the marks around them."""
        low = max(0, int(np.searchsorted(self.marks, start, side="right")) - 1)
        high = int(np.searchsorted(self.marks, start + n, side="left"))
        symbols = self.grammar.symbols[low * MARK_EVERY : high * MARK_EVERY]
        begin = start - (int(self.marks[low]) if len(self.marks) else 0)
        return self.grammar.expand(symbols)[begin : begin + n]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    vocabulary: int = 50257,
    text: str = "text",
    doc_id: str = "doc_id",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Write the ids of all texts, each followed by ``end_id``, to shards at ``path`` in ascending ``doc_id``.

    Null texts are empty, so they have the end id alone; a null ``doc_id`` comes last; repeated rows are
    written as often as they occur. A text longer than a shard has a shard of its own. An empty table
    makes an empty folder of shards. Other columns are left out.
    """
    ship(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held_ids, held_sizes, held_docs, number = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids, sizes, names = np.concatenate(held_ids), np.concatenate(held_sizes), np.concatenate(held_docs)
            payload = pack_shard(ids, names, np.concatenate([[0], np.cumsum(sizes)]), vocabulary, end_id)
            columns = [[(task << 32) + number], [len(names)], [len(ids)], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["shard", "documents", "ids", "payload"],
            )

        for part, ids, offsets in encoded(batches, tokenizer, text, end_id):
            names, at = filled_ids(part.column(doc_id), LAST_ID), 0
            while at < len(names):
                room = shard_ids - sum(map(len, held_ids))
                stop = int(np.searchsorted(offsets, offsets[at] + room, side="right")) - 1
                if stop <= at and held_ids:
                    yield flush()
                    held_ids, held_sizes, held_docs, number = [], [], [], number + 1
                    continue
                stop = max(stop, at + 1)
                held_ids.append(ids[offsets[at] : offsets[stop]])
                held_sizes.append(np.diff(offsets[at : stop + 1]))
                held_docs.append(names[at:stop])
                at = stop
        if held_ids:
            yield flush()

    # rows of one id, or none, are told apart by their texts, so that they need not meet in one range
    columns = docs.select(F.coalesce(doc_id, F.lit(LAST_ID)).alias(doc_id), text, F.xxhash64(text).alias("_order"))
    ranges = pieces_for(text_size(docs, text), RANGE_BYTES)
    ordered = columns.repartitionByRange(ranges, doc_id, "_order").sortWithinPartitions(doc_id, "_order").drop("_order")
    ordered.mapInArrow(write, SHARD_SCHEMA).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the shards: ``doc_id, start, n_tokens, ids``; ``start`` counts all ids before it."""
    ship(spark)
    shards = read_shards(spark, path)
    index = running_total(shards.select("shard", "ids", F.lit(0).alias("_all")), ["_all"], "shard", "ids", "first")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column(2)[row].as_py())
                offsets = shard.offsets
                flat = np.ascontiguousarray(shard.all_ids(), dtype="<u4")
                values = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(shard.docs), [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(flat)]
                )
                names = pa.array(shard.docs, pa.int64(), mask=shard.docs == LAST_ID)
                first = batch.column(1)[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(first + offsets[:-1]), pa.array(np.diff(offsets)), values.cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    joined = shards.select("shard", "payload").join(index.select("shard", "first"), "shard")
    return joined.select("shard", "first", "payload").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def token_folder(root: str) -> str:
    return f"{root}/tokens/{uuid4().hex}"
