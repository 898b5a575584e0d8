"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, then a seeded choice of blocks.

The words of a source, its documents in a seeded order, are one line, cut into equal blocks of about
``block`` words. The mix has as many blocks as the targets hold; they go one by one to the source with
the highest quotient, target blocks / (2 * blocks so far + 1), so each source gets a whole number of
them. A quota of several whole passes over the line takes every block that often; what is left of it is
dealt over the line's shards (``SHARD_BLOCKS`` consecutive blocks each) by highest quotients again, which
for such shards is a division with remainder, the larger shards first. Within a shard the blocks with
the smallest keyed hashes are taken once more. A shard's choice depends on seed, source and quota only,
so every task that meets a piece of a shard makes the same one.

Texts are read once, to count their words; what is shuffled are ids and counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import LAST_ID, numbered, running_total, scratch, ship
from tallyworks.llm.words import mix
from tallyworks.operators.joins import join_hot

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 32
SHARD_BLOCKS = 4096
BUCKET_ROWS = 32_768
BUCKET_WORDS = 1 << 24
WORD = r"[^\x20\x09-\x0D]+"

_MASK = (1 << 64) - 1


def n_words(text: str) -> Column:
    """Number of words of a text; 0 for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, most: int) -> DataFrame:
    """Add ``target``: the sum of all ``source_size``, shared by ``weight``, none above ``most`` times its own size.

    A source is above if most * size / weight is less than the share of one weight; what it cannot take
    raises that share for the others, so sources only ever join those that are full. Each turn is one
    aggregation; sums are whole numbers, so no turn depends on the order of addition.
    """

    def whole(value: int) -> Column:
        return F.lit(Decimal(value)).cast("decimal(38,0)")

    size, weight = F.col("source_size").cast("decimal(38,0)"), F.col("weight").cast("decimal(38,0)")
    row = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, rest, parts = int(row[0] or 0), int(row[0] or 0), int(row[1] or 1)
    while True:
        full = (size * most) * whole(parts) < weight * whole(rest)
        taken, still = sources.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        now = total - most * int(taken or 0), int(still or 1)
        if now == (rest, parts):
            share = F.lit(float(rest)) * F.col("weight") / F.lit(float(parts))
            return sources.withColumn("target", F.when(full, F.col("source_size").cast("double") * most).otherwise(share))
        rest, parts = now


def apportion(units: DataFrame, votes: str, most: str, seats: int, order: str, out: str) -> DataFrame:
    """Add ``out``: how many of ``seats`` each unit gets by the highest quotients votes / (2k + 1), at most ``most``.

    Rounding votes at one price, with full units left out of it as in ``targets``, is where highest
    quotients lead but for a few seats: half as many as there are units. Only the quotients next to that
    state are listed, and the best of them are granted, or the worst taken back; equal ones go to the
    unit that comes first by ``order``. With fewer seats in all ``most`` than ``seats``, all are given.
    """
    vote, limit = F.col(votes), F.col(most)
    total = units.agg(F.sum(votes)).first()[0]
    if not total or seats < 1:
        return units.withColumn(out, F.lit(0).cast("long"))
    price = seats / total
    while True:
        full = vote * F.lit(price) >= limit
        taken, still = units.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, vote))).first()
        if not still or (seats - (taken or 0)) / still <= price:
            break
        price = (seats - (taken or 0)) / still
    start = F.when(full, limit).otherwise(F.least(limit, F.floor(vote * F.lit(price) + 0.5))).cast("long")
    units = scratch(units.withColumn("_given", start))
    n, given, open_votes = units.agg(F.count("*"), F.sum("_given"), F.sum(F.when(F.col("_given") < limit, vote))).first()
    lack = seats - given
    spare = F.floor(vote / F.lit(open_votes or total) * F.lit(2 * (abs(lack) + n))).cast("long") + 3
    if lack > 0:
        first, last, step = F.col("_given"), F.least(F.col(most), F.col("_given") + spare) - 1, 1
    else:
        first, last, step = F.greatest(F.lit(0), F.col("_given") - spare), F.col("_given") - 1, -1
    near = units.select(order, votes, F.explode(F.when(first <= last, F.sequence(first, last))).alias("_k"))
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    ranked = near.orderBy(quotient.desc(), F.col(order), F.col("_k")) if lack > 0 else near.orderBy(quotient, F.col(order).desc(), F.col("_k").desc())
    moved = ranked.limit(abs(lack)).groupBy(F.col(order).alias("_unit")).agg(F.count("*").alias("_moved"))
    joined = units.join(moved, F.col(order) == F.col("_unit"), "left").drop("_unit")
    return joined.withColumn(out, F.col("_given") + step * F.coalesce("_moved", F.lit(0))).drop("_given", "_moved")


def source_quotas(sized: DataFrame, weights: Sequence[int], most: int, block: int) -> DataFrame:
    """One row a source: its size, target, number of blocks and quota of them."""
    found = sized.groupBy("_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    ranked = numbered(found, [F.col("source").isNull(), F.col("source")], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")).cast("long")
    shared = targets(scratch(ranked.withColumn("weight", weight)), most)
    blocks = F.when(F.col("source_size") > 0, F.greatest(F.lit(1), F.floor((F.col("source_size") * 2 + block) / (2 * block)))).otherwise(0)
    votes = F.when(F.col("source_size") > 0, F.col("target") * F.col("_blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    cut = shared.withColumn("_blocks", blocks.cast("long")).withColumn("_votes", votes).withColumn("_most", F.col("_blocks") * most)
    cut = scratch(cut)
    seats = round(cut.agg(F.sum("_votes")).first()[0] or 0)
    return scratch(apportion(cut, "_votes", "_most", seats, "_rank", "_quota"))


class Line:
    """A source's line of words: where its blocks lie and how often each is taken."""

    def __init__(self, size: int, blocks: int, quota: int, rank: int, seed: int):
        self.size, self.blocks = size, blocks
        self.long, self.length = size % blocks, size // blocks  # the first ``long`` blocks have one word more
        self.passes, self.extra = quota // blocks, quota % blocks
        self.shards = -(-blocks // SHARD_BLOCKS)
        self.longer, self.per_shard = blocks % self.shards, blocks // self.shards
        key = (seed * 0x9E3779B97F4A7C15 + rank * 0xC2B2AE3D27D4EB4F) & _MASK
        self.key = mix(np.array([key], dtype=np.uint64))[0]

    def begin(self, block: np.ndarray) -> np.ndarray:
        return block * self.length + np.minimum(block, self.long)

    def block_at(self, word: np.ndarray) -> np.ndarray:
        edge = self.long * (self.length + 1)
        return np.where(word < edge, word // (self.length + 1), self.long + (word - edge) // max(1, self.length))

    def shard_begin(self, shard: int) -> int:
        return shard * self.per_shard + min(shard, self.longer)

    def shard_of(self, block: int) -> int:
        edge = self.longer * (self.per_shard + 1)
        return block // (self.per_shard + 1) if block < edge else self.longer + (block - edge) // max(1, self.per_shard)

    def copies(self, shard: int) -> np.ndarray:
        """How often each block of a shard is taken."""
        first, stop = self.shard_begin(shard), self.shard_begin(shard + 1)
        quota = self.extra // self.shards + (shard < self.extra % self.shards)
        keys = mix(np.arange(first, stop, dtype=np.uint64) ^ self.key)
        out = np.full(stop - first, self.passes, dtype=np.int64)
        out[np.argsort(keys, kind="stable")[:quota]] += 1
        return out

    def runs(self, first_word: int, stop_word: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin of each run of equally often taken words that covers the given words (and the end), and the copies."""
        ends = self.block_at(np.array([first_word, max(first_word, stop_word - 1)]))
        shards = range(self.shard_of(int(ends[0])), self.shard_of(int(ends[1])) + 1)
        copies = np.concatenate([self.copies(s) for s in shards])
        first = self.shard_begin(shards[0])
        new = np.ones(len(copies), dtype=bool)
        new[1:] = copies[1:] != copies[:-1]
        at = np.flatnonzero(new)
        return self.begin(np.append(at, len(copies)) + first), copies[at]


def _taker(seed: int, spans: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Lays one bucket of documents on its source's line and reads off what is taken of each."""

    def take(docs: pa.Table, offsets: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        size = docs.column("size").to_numpy()
        ids = pc.fill_null(docs.column("doc_id").cast(pa.int64()), LAST_ID).to_numpy()
        order = np.lexsort((size, ids, docs.column("_hash").to_numpy()))
        docs, size = docs.take(pa.array(order)), size[order]
        row = docs.slice(0, 1).select(["source_size", "_blocks", "_quota", "_rank"]).to_pylist()[0]
        stop = offsets.column("_offset")[0].as_py() + np.cumsum(size)
        start = stop - size
        taken = np.zeros(len(size), dtype=np.int64)
        lists = [[] for _ in size] if spans else None
        if len(size) and stop[-1] > start[0]:
            line = Line(row["source_size"], row["_blocks"], row["_quota"], row["_rank"], seed)
            begin, copies = line.runs(int(start[0]), int(stop[-1]))
            before = np.concatenate([[0], np.cumsum(copies * np.diff(begin))])

            def upto(word: np.ndarray) -> np.ndarray:
                at = np.clip(np.searchsorted(begin, word, side="right") - 1, 0, len(copies) - 1)
                return before[at] + copies[at] * (word - begin[at])

            taken = upto(stop) - upto(start)
            if spans:
                low = np.searchsorted(begin, start, side="right") - 1
                high = np.searchsorted(begin, stop, side="left")
                for i in np.flatnonzero(taken):
                    runs = range(low[i], high[i])
                    cut = [(max(begin[r], start[i]) - start[i], min(begin[r + 1], stop[i]) - start[i], copies[r]) for r in runs if copies[r]]
                    lists[i] = [{"first": int(a), "stop": int(b), "copies": int(c)} for a, b, c in cut]
        out = docs.select(["doc_id", "source", "size", "source_size", "target"]).append_column("taken", pa.array(taken, pa.int64()))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("copies", pa.int32())]))
        return out.append_column("spans", pa.array(lists if spans else [None] * len(size), kind))

    return take


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    seed: int = 7,
    spans: bool = True,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """What a mix of all sources takes of each document.

    One row a document: ``doc_id, source, size, source_size, target, taken, spans``. Sizes are words,
    runs of characters other than space and 0x09-0x0D. Sources stand in code-point order, null as the
    last one, and get ``weights`` in turn, repeating; they share the size of all documents by weight, but
    none has a target above ``most`` times its size, and what it cannot take is shared by the others.
    ``taken`` is the number of the document's words in the mix, repeats counted, never above ``most``
    times its size; ``spans`` says which: words ``first`` to ``stop`` (excluded), ``copies`` times.
    Without ``spans`` that column is null.

    A source's ``taken`` lies within a block or two of its target, and a word for each block it has at
    most. The same rows and seed give the same result, however they are partitioned.

    Null and empty texts have size 0 and nothing is taken of them; a source of only such texts has
    target 0. A null ``doc_id`` counts as the largest id. Rows with one ``doc_id`` are mixed each by
    itself. Other columns are left out; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    name = F.col(source).cast("string")
    sized = docs.select(F.col(doc_id).cast("long").alias("doc_id"), name.alias("source"), n_words(text).alias("size"), F.xxhash64(text).alias("_text"))
    sized = sized.select(
        "doc_id", "source", "size", F.xxhash64(F.lit(seed), "doc_id", "size", "_text").alias("_hash"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("_key")
    )
    sized = scratch(sized)
    sources = source_quotas(sized, weights, most, block)
    parts = F.greatest(F.lit(1), F.ceil(F.col("_docs") / BUCKET_ROWS), F.ceil(F.col("source_size") / BUCKET_WORDS))
    known = sources.select("_key", "_rank", "source_size", "target", "_blocks", "_quota", parts.cast("long").alias("_buckets"))
    dealt = join_hot(sized, known, "_key").withColumn("_bucket", F.pmod("_hash", "_buckets")).drop("_key", "_buckets")
    heads = dealt.groupBy("_rank", "_bucket").agg(F.sum("size").alias("_words"))
    offsets = running_total(scratch(heads), ["_rank"], "_bucket", "_words", "_offset")
    schema = "doc_id long, source string, size long, source_size long, target double, taken long, spans array<struct<first: long, stop: long, copies: int>>"
    pairs = dealt.groupBy("_rank", "_bucket").cogroup(offsets.groupBy("_rank", "_bucket"))
    return pairs.applyInArrow(_taker(seed, spans), schema)
