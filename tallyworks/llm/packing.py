"""Best-fit packing of token pieces into sequences of a fixed length, with exact complements first.

Only how many pieces there are of each length matters for the plan, and that is a table of at most
``limit`` rows whatever the corpus holds. The plan is made on it: for each length, longest first, the
gap it leaves is looked up among single lengths, then sums of two, then of three, all indexed under
the counts still available, and a combination that fills the gap exactly is used as often as the
counts allow. What is left goes best-fit, longest first, again many sequences at a time. Each step
uses up a length or a group of open sequences, so the plan stays small. Pieces then take their places
by rank within their length, in parallel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import FILE_ROWS, pieces_for, release, running_total, scratch, ship
from tallyworks.llm.token_ids import binary_column, encoded

LIMIT = 2048
RANK_ROWS = 2_000


@dataclass
class PackingPlan:
    """Where the pieces of each length go: ranks ``first`` on take ``each`` places a sequence."""

    limit: int
    sequences: int = 0
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, first rank, each, sequence, offset

    def arrays(self) -> tuple[np.ndarray, ...]:
        ordered = sorted(self.slots)
        return tuple(np.array([s[i] for s in ordered], dtype=np.int64) for i in range(5))


class _Planner:
    def __init__(self, counts: dict[int, int], limit: int):
        self.plan = PackingPlan(limit)
        self.left = np.zeros(limit + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.rank = np.zeros(limit + 1, dtype=np.int64)
        # How many ordered pairs of available lengths have each sum.
        have = (self.left > 0).astype(np.int64)
        self.pair_sums = np.convolve(have, have)[: limit + 1]

    def _used(self, length: int, n: int) -> None:
        self.rank[length] += n
        self.left[length] -= n
        if n and not self.left[length]:
            have = self.left > 0
            limit = self.plan.limit
            self.pair_sums[length:][have[: limit + 1 - length]] -= 2
            if 2 * length <= limit:
                self.pair_sums[2 * length] -= 1

    def _slot(self, length: int, n: int, each: int, sequence: int, offset: int) -> None:
        self.plan.slots.append((length, int(self.rank[length]), each, sequence, offset))
        self._used(length, n)

    def _fits(self, parts: tuple[int, ...]) -> int:
        """How often the combination can be taken."""
        return min(int(self.left[length]) // n for length, n in Counter(parts).items())

    def _pair(self, total: int, longest: int) -> tuple[int, int] | None:
        if total < 2 or self.pair_sums[total] <= 0:
            return None
        high = np.arange(min(longest, total - 1), (total - 1) // 2, -1)
        low = total - high
        good = (self.left[high] > 0) & (self.left[low] > 0) & ((high != low) | (self.left[high] > 1))
        at = int(np.argmax(good)) if len(good) else 0
        return (int(high[at]), int(low[at])) if len(good) and good[at] else None

    def complement(self, length: int) -> tuple[int, ...] | None:
        """Lengths that fill a sequence up behind one piece of ``length``, none of them longer than it."""
        gap = self.plan.limit - length
        self.left[length] -= 1
        try:
            if gap <= length and self.left[gap] > 0:
                return (gap,)
            pair = self._pair(gap, length)
            if pair:
                return pair
            firsts = np.arange(min(length, gap - 2), (gap + 2) // 3 - 1, -1)
            firsts = firsts[(firsts > 0) & (self.left[firsts] > 0)] if len(firsts) else firsts
            for a in firsts[self.pair_sums[gap - firsts] > 0] if len(firsts) else ():
                self.left[a] -= 1
                rest = self._pair(gap - int(a), int(a))
                self.left[a] += 1
                if rest:
                    return (int(a), *rest)
            return None
        finally:
            self.left[length] += 1

    def exact(self) -> None:
        limit = self.plan.limit
        if self.left[limit]:
            n = int(self.left[limit])
            self._slot(limit, n, 1, self.plan.sequences, 0)
            self.plan.sequences += n
        for length in range(limit - 1, 0, -1):
            while self.left[length] > 0:
                rest = self.complement(length)
                if rest is None:
                    break
                parts = (length, *rest)
                n, offset = self._fits(parts), 0
                for one, each in Counter(parts).items():
                    self._slot(one, n * each, each, self.plan.sequences, offset)
                    offset += one * each
                self.plan.sequences += n

    def best_fit(self) -> None:
        """The rest, longest first, each into the open sequences with the smallest gap that takes it."""
        limit = self.plan.limit
        open_: list[tuple[int, int, int]] = []  # gap, first sequence, how many

        def put(length: int, count: int, gap: int, sequence: int, width: int) -> int:
            """Fill ``width`` sequences with one gap; returns how many pieces went in."""
            each = gap // length
            full = min(width, count // each)
            if full:
                self._slot(length, full * each, each, sequence, limit - gap)
                if gap - each * length:
                    insort(open_, (gap - each * length, sequence, full))
            rest = min(count - full * each, each - 1) if full < width else 0
            if rest:
                self._slot(length, rest, rest, sequence + full, limit - gap)
                if gap - rest * length:
                    insort(open_, (gap - rest * length, sequence + full, 1))
            begun = full + bool(rest)
            if begun < width:
                insort(open_, (gap, sequence + begun, width - begun))
            return full * each + rest

        for length in range(limit, 0, -1):
            count = int(self.left[length])
            while count:
                at = bisect_left(open_, (length, -1, -1))
                if at < len(open_):
                    count -= put(length, count, *open_.pop(at))
                else:
                    new = -(-count // (limit // length))
                    first = self.plan.sequences
                    self.plan.sequences += new
                    count -= put(length, count, limit, first, new)


def plan_packing(counts: dict[int, int], limit: int = LIMIT) -> PackingPlan:
    """Sequences for ``counts`` pieces of each length from 1 to ``limit``."""
    planner = _Planner(counts, limit)
    planner.exact()
    planner.best_fit()
    return planner.plan


def _piece_spans(n: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids: the first takes what is over."""
    if n <= limit:
        return [(0, n)]
    head = n % limit
    return [(0, head)] * (head > 0) + [(s, limit) for s in range(head, n, limit)]


def document_pieces(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = 0, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Token pieces of each document: ``doc_id, piece, start, length, ids``.

    ``ids`` are little-endian unsigned 32-bit integers, the document's own and then ``end_id``. Only a
    document longer than ``limit`` is cut, into pieces of ``limit`` ids of which the first may be
    shorter. Null and empty texts have one piece with the end id alone. A null ``doc_id`` stays null.
    Other columns are left out; repeated rows each have their own pieces.
    """
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, offsets in encoded(batches, tokenizer, text, end_id):
            spans = [(i, k, s, n) for i, size in enumerate(np.diff(offsets)) for k, (s, n) in enumerate(_piece_spans(int(size), limit))]
            row, piece, start, length = (np.array(c, dtype=np.int64) for c in zip(*spans, strict=True)) if spans else (np.zeros(0, np.int64),) * 4
            bounds = np.append((offsets[row] + start), len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(doc_id).cast(pa.int64()).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    binary_column(ids, bounds),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(cut, schema)


def pack(pieces: DataFrame, limit: int = LIMIT, rank_rows: int = RANK_ROWS) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and more) with ``sequence_id`` and ``offset`` for each.

    Sequences are filled from offset 0 without gaps. ``pieces`` is read three times, so it should be a
    written table. Lengths are from 1 to ``limit``; others raise an error. Ties and repeated rows are
    placed in the order of ``doc_id`` and ``piece``, each row once. An empty table gives an empty one.
    A length that a third of all pieces have is ranked in as many parts as its rows need.
    """
    ship(pieces.sparkSession)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(length is None or not 1 <= length <= limit for length in histogram):
        raise ValueError(f"a piece has fewer than 1 or more than {limit} ids")
    plan = plan_packing(histogram, limit)
    lengths, firsts, each, sequences, offsets = plan.arrays()
    parts = pieces_for(sum(histogram.values()), rank_rows)
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = running_total(salted.groupBy("length", "_part").agg(F.count("*").alias("_n")), ["length"], "_part", "_n", "_before")
    ranked = salted.withColumn("_row", F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(before.select("length", "_part", "_before"), ["length", "_part"]).coalesce(pieces_for(sum(histogram.values()), FILE_ROWS))
    span = np.int64(1) << np.int64(48)
    starts = lengths * span + firsts

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        release()  # the encoder that this worker may have kept
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(starts, length * span + rank, side="right") - 1
        inner = rank - firsts[at]
        return pd.DataFrame({"sequence_id": sequences[at] + inner // each[at], "offset": offsets[at] + inner % each[at] * length})

    placed = ranked.withColumn("_place", place("length", (F.col("_row") + F.col("_before")).cast("long")))
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return placed.select(*kept, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))


def packed_sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, n_tokens, ids, doc_ids`` from placed pieces with their ``ids``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("_p"))
    ids = F.aggregate("_p", F.lit(b"").cast("binary"), lambda whole, p: F.concat(whole, p["ids"]))
    return joined.select("sequence_id", "n_tokens", ids.alias("ids"), F.col("_p.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and place ``docs``: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``."""
    pieces = document_pieces(docs, tokenizer, limit, end_id).withColumn("ids_crc32", F.crc32("ids"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    return pack(scratch(pieces.select(*kept)), limit)


