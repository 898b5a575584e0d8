"""Prefix trie of conversations from padded matrices of turn ids, shard by shard.

A turn stands for itself by a 128-bit hash of role, text and place. Conversations, cut into stretches of
``STRETCH`` turns, are range-sharded by the ids of their turns, so that those with a common beginning lie
together. A shard is a matrix, one row a conversation, padded to ``COLUMNS`` turns at a time (only rows that
go on take part in the next columns): numpy's lexsort puts the rows in order, a mask marks where a column
differs from the row above, and or-ing the masks from left to right marks where a new prefix starts, which
is a node. ``reduceat`` over these starts sums up every depth; children add up to their parents from the
deepest column upwards.

Nodes that may go on beyond their shard are those above its first and last row, and those above a
conversation with further stretches. They come out as partial sums, are added up by their key, and form
a small tree of their own in which sums move to ancestors of distance 1, 2, 4 and so on. So neither a
beginning that most conversations share nor a very long conversation meets in one task. Only the digest
of the conversations that end at one node, which is one SHA-256 and cannot be cut, is one task's work:
their ids stream through it in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import LAST_ID, numbered, pieces_for, scratch, ship
from tallyworks.operators.joins import join_hot

STRETCH = 128
COLUMNS = 16
SHARD_ROWS = 32_768

_NODE = (
    "edge boolean, hi long, lo long, parent_hi long, parent_lo long, parent_edge boolean, parent_conv long, depth long, conv_id long, "
    "n_convs long, rest long, deep long, own long, distinct long, leaves long, children long, ends_here boolean"
)


def numbered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every turn with its place from 1 (``conv_id, place, hi, lo, size``), and one row a conversation (``conv_id, n``)."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("hi"),
        F.xxhash64(F.lit(2), *said[::-1]).alias("lo"),
        F.octet_length(said[1]).cast("long").alias("size"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("hi"), F.col("lo"), F.col("size")]
    turns = numbered(turns, order, "_at")
    heads = scratch(turns.groupBy("conv_id").agg(F.min("_at").alias("_first"), F.count("*").alias("n")))
    placed = join_hot(turns, heads, "conv_id").withColumn("place", F.col("_at") - F.col("_first") + 1)
    return placed.select("conv_id", "place", "hi", "lo", "size"), heads.select("conv_id", "n")


def rebuilt_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (``conv_id, place, hi, lo, size``) and their lengths (``conv_id, total``).

    A conversation c begins with the first h turns of conversation c - c % 5, where h is crc32(c) % 9, and goes
    on with its own turns after its first h. A conversation lends its beginning to at most nine others.
    """
    turns, lengths = numbered_turns(conversations, conv_id, turn, role, text)
    turns = scratch(turns)
    base = (F.col("conv_id") - F.col("conv_id") % 5).alias("_base")
    cut = (F.crc32(F.col("conv_id").cast("string")) % 9).alias("_cut")
    convs = lengths.select("conv_id", "n", base, cut)
    lent = lengths.select(F.col("conv_id").alias("_base"), F.col("n").alias("_lender"))
    convs = convs.join(lent, "_base", "left").withColumn("_lent", F.least("_cut", F.coalesce("_lender", F.lit(0))))
    convs = scratch(convs.select("conv_id", "_base", "_cut", "_lent", (F.col("_lent") + F.greatest(F.col("n") - F.col("_cut"), F.lit(0))).alias("total")))
    own = join_hot(turns, convs.select("conv_id", "_cut", "_lent"), "conv_id").filter(F.col("place") > F.col("_cut"))
    own = own.select("conv_id", (F.col("place") - F.col("_cut") + F.col("_lent")).alias("place"), "hi", "lo", "size")
    starts = turns.filter(F.col("place") <= 8).withColumnRenamed("conv_id", "_base")
    begin = starts.join(convs.select("conv_id", "_base", "_cut"), "_base").filter(F.col("place") <= F.col("_cut"))
    return own.unionByName(begin.select("conv_id", "place", "hi", "lo", "size")), convs.select("conv_id", "total")


def _stretches(turns: DataFrame, lengths: DataFrame, stretch: int) -> DataFrame:
    """One row a stretch: ``conv_id, level, turns, sum_hi, sum_lo, goes_on, key_hi, key_lo``; the key stands for all turns before it.

    Keys are the xor of the hashes of the turns, each mixed with its place.
    """
    tagged = turns.select(
        "conv_id",
        F.floor((F.col("place") - 1) / stretch).alias("level"),
        F.struct("place", F.xxhash64("place", "hi", "lo").alias("hi"), F.xxhash64("lo", "hi", "place").alias("lo"), "size").alias("turn"),
    )
    rows = tagged.groupBy("conv_id", "level").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"), F.bit_xor("turn.hi").alias("sum_hi"), F.bit_xor("turn.lo").alias("sum_lo")
    )
    bare = lengths.filter("total = 0").select("conv_id", F.lit(0).cast("long").alias("level"), F.lit(0).cast("long").alias("sum_hi"), F.lit(0).cast("long").alias("sum_lo"))
    rows = scratch(rows.unionByName(bare.withColumn("turns", F.lit(None).cast(rows.schema["turns"].dataType))))
    is_full = F.coalesce(F.size("turns"), F.lit(0)) == stretch
    full = rows.filter(is_full).join(lengths, "conv_id").withColumn("goes_on", F.col("total") > (F.col("level") + 1) * stretch).drop("total")
    rows = rows.filter(~is_full).withColumn("goes_on", F.lit(False)).unionByName(full)
    earlier = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    # only conversations of several stretches have keys to look up
    long_ones = rows.join(lengths.filter(F.col("total") > stretch), "conv_id", "left_semi").select("conv_id", "level", "sum_hi", "sum_lo")
    keys = long_ones.select("conv_id", "level", F.bit_xor("sum_hi").over(earlier).alias("key_hi"), F.bit_xor("sum_lo").over(earlier).alias("key_lo"))
    zero = F.lit(0).cast("long")
    first = rows.filter("level = 0").select("*", zero.alias("key_hi"), zero.alias("key_lo"))
    later = rows.filter("level > 0").join(keys.filter("level > 0"), ["conv_id", "level"])
    return first.unionByName(later)


class _Shard:
    """The nodes of one shard of stretches."""

    def __init__(self, table: pa.Table, stretch: int, columns: int):
        import pyarrow.compute as pc

        column = {n: table.column(n).combine_chunks() for n in table.column_names}
        self.conv = column["conv_id"].to_numpy()
        self.level = column["level"].to_numpy()
        self.key = np.stack([column["key_hi"].to_numpy(), column["key_lo"].to_numpy()]).view(np.uint64)
        self.goes_on = column["goes_on"].to_numpy(zero_copy_only=False)
        turns = column["turns"]
        self.size = turns.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = {n: pc.struct_field(turns.flatten(), n).to_numpy() for n in ("hi", "lo", "size")}
        self.turn = np.stack([flat["hi"], flat["lo"]]).view(np.uint64)
        self.bytes = flat["size"]
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int64)
        self.stretch, self.columns = stretch, columns
        self.found: list[dict[str, np.ndarray]] = []
        # dense turn ids in the order of the hashes (as signed numbers, which is how Spark sorts them)
        order = np.lexsort(self.turn.view(np.int64)[::-1])
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.turn[:, order[1:]] != self.turn[:, order[:-1]]).any(axis=0)
        self.ids = np.empty(len(order), dtype=np.int64)
        self.ids[order] = np.cumsum(new) - 1
        self._order()

    def _matrix(self, rows: np.ndarray, first: int) -> np.ndarray:
        """Turn ids of ``rows`` from column ``first`` on, padded with -1."""
        at = first + np.arange(self.columns)
        inside = at[None, :] < self.size[rows][:, None]
        places = np.where(inside, self.begin[rows][:, None] + at[None, :], 0)
        return np.where(inside, self.ids[places] if len(self.ids) else -1, -1)

    def _order(self) -> None:
        """Sort the rows by level, key, turns and conversation, some columns at a time."""
        order = np.lexsort((*self.key.view(np.int64)[::-1], self.level))
        group = np.zeros(len(order), dtype=np.int64)
        changed = (self.level[order[1:]] != self.level[order[:-1]]) | (self.key[:, order[1:]] != self.key[:, order[:-1]]).any(axis=0)
        group[order[1:]] = np.cumsum(changed)
        self.group = group.copy()
        for first in range(0, int(self.size.max(initial=0)), self.columns):
            rows = np.flatnonzero(self.size > first)
            matrix = self._matrix(rows, first)
            order = np.lexsort((*matrix.T[::-1], group[rows]))
            changed = np.concatenate([[True], (matrix[order[1:]] != matrix[order[:-1]]).any(axis=1) | (group[rows[order[1:]]] != group[rows[order[:-1]]])])
            rank = np.zeros(len(group), dtype=np.int64)  # shorter rows come before those that go on
            rank[rows[order]] = np.cumsum(changed)
            order = np.lexsort((rank, group))
            changed = (group[order[1:]] != group[order[:-1]]) | (rank[order[1:]] != rank[order[:-1]])
            group = np.zeros(len(group), dtype=np.int64)
            group[order[1:]] = np.cumsum(changed)
        self.order = np.lexsort((self.conv, group))

    def _column(self, rows: np.ndarray, starts: np.ndarray, real: np.ndarray, depth: int) -> None:
        """Nodes of one depth of the shard: ``starts`` cut the sorted rows ``rows``; only ``real`` cuts hold nodes."""
        if not real.any():
            return
        at = self.order[rows]
        local = depth - 1
        ends = np.append(starts[1:], len(rows))[real]
        head = at[starts[real]]
        rest = self.upto[self.begin[at] + self.size[at]] - self.upto[self.begin[at] + np.minimum(max(local, 0), self.size[at])]
        flag = (rows == 0) | (rows == len(self.order) - 1) | self.goes_on[at] | (depth == 0)
        further = (self.size[at] > depth) | (self.goes_on[at] & (self.size[at] == depth))

        def over(kernel: np.ufunc, values: np.ndarray) -> np.ndarray:
            return kernel.reduceat(values, starts)[real]

        prefix = np.zeros((2, len(head)), dtype=np.uint64)
        if depth:
            prefix = self.xored[:, self.begin[head] + depth] ^ self.xored[:, self.begin[head]]
        upper = depth == 0 and self.level[head] > 0  # stands for a node of the stretch before
        self.found.append(
            {
                "row": rows[starts[real]],
                "depth": self.level[head] * self.stretch + depth,
                "key": (prefix ^ self.key[:, head]).view(np.int64),
                "edge": over(np.logical_or, flag),
                "conv": np.where(upper, LAST_ID, over(np.minimum, self.conv[at])),
                "n": np.where(upper, 0, ends - starts[real]),
                "rest": np.where(upper, 0, over(np.add, rest)),
                "deep": np.where(upper, over(np.add, rest), 0),
                "own": self.bytes[self.begin[head] + local] if depth else np.zeros(len(head), dtype=np.int64),
                "further": over(np.logical_or, further),
            }
        )

    def nodes(self) -> pa.RecordBatch:
        self.upto = np.concatenate([[0], np.cumsum(self.bytes)])
        self.xored = np.concatenate([np.zeros((2, 1), dtype=np.uint64), np.bitwise_xor.accumulate(self.turn, axis=1)], axis=1)
        rows = np.arange(len(self.order))
        group = self.group[self.order]
        change = np.concatenate([[True], group[1:] != group[:-1]])
        starts = np.flatnonzero(change)
        self._column(rows, starts, np.ones(len(starts), dtype=bool), 0)
        for first in range(0, int(self.size.max(initial=0)), self.columns):
            on = self.size[self.order[rows]] > first
            part = np.cumsum(change)[on]
            rows = rows[on]
            matrix = self._matrix(self.order[rows], first)
            mask = np.ones(matrix.shape, dtype=bool)
            mask[1:] = matrix[1:] != matrix[:-1]
            mask[1:, 0] |= part[1:] != part[:-1]
            mask = np.logical_or.accumulate(mask, axis=1)
            for k in range(self.columns):
                starts = np.flatnonzero(mask[:, k])
                self._column(rows, starts, matrix[starts, k] >= 0, first + k + 1)
            change = mask[:, -1]
        return self._summed()

    def _summed(self) -> pa.RecordBatch:
        """Add the inner nodes up to their parents, deepest first, and hand all nodes out."""
        below = None
        for depth in range(len(self.found) - 1, -1, -1):
            now = self.found[depth]
            n = len(now["row"])
            now["distinct"], now["leaves"], now["children"] = (np.zeros(n, dtype=np.int64) for _ in range(3))
            if below is not None:
                parent = np.searchsorted(now["row"], below["row"], side="right") - 1
                inner = ~below["edge"]
                for name, value in (("distinct", below["distinct"]), ("leaves", below["leaves"]), ("children", np.ones(len(parent), dtype=np.int64))):
                    np.add.at(now[name], parent[inner], value[inner])
                below["parent"] = now["key"][:, parent]
                below["parent_edge"] = now["edge"][parent]
                below["parent_conv"] = now["conv"][parent]
            inner = ~now["edge"]
            now["distinct"] += np.where(inner, now["own"], 0)
            now["leaves"] += inner & ~now["further"]
            below = now
        roots = self.found[0]
        roots["parent"], roots["parent_edge"] = np.zeros_like(roots["key"]), np.zeros(len(roots["row"]), dtype=bool)
        roots["parent_conv"] = roots["conv"]
        every = {k: np.concatenate([f[k] for f in self.found], axis=-1) for k in roots}
        rootless = np.arange(len(every["row"])) < len(roots["row"])
        far = rootless | ~every["parent_edge"]
        fields = {
            "edge": every["edge"],
            "hi": every["key"][0],
            "lo": every["key"][1],
            "parent_hi": pa.array(every["parent"][0], mask=rootless),
            "parent_lo": pa.array(every["parent"][1], mask=rootless),
            "parent_edge": ~far,
            "parent_conv": pa.array(every["parent_conv"], mask=rootless | every["parent_edge"]),
            "depth": every["depth"],
            "conv_id": every["conv"],
            "n_convs": every["n"],
            "rest": every["rest"],
            "deep": every["deep"],
            "own": every["own"],
            "distinct": every["distinct"],
            "leaves": every["leaves"],
            "children": every["children"],
            "ends_here": ~every["further"],
        }
        return pa.record_batch([v if isinstance(v, pa.Array) else pa.array(v) for v in fields.values()], names=list(fields))


def _sharder(stretch: int, columns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if len(b)]
        if whole:
            yield _Shard(pa.Table.from_batches(whole), stretch, columns).nodes()

    return sharded


def _add_up(edges: DataFrame) -> DataFrame:
    """Edge nodes, each once, with sums over their whole subtrees: partial sums by key, then doubling along parents."""
    whole = edges.groupBy("hi", "lo").agg(
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(F.col("parent_hi").isNotNull(), F.struct("parent_hi", "parent_lo"))).alias("_parent"),
        *[F.sum(c).alias(c) for c in ("n_convs", "rest", "deep", "distinct", "leaves", "children")],
        F.max("own").alias("own"),
        F.bool_and("ends_here").alias("ends_here"),
    )
    whole = whole.withColumn("saved", F.col("deep") - F.col("distinct") - F.col("own"))
    whole = whole.withColumn("leaves", F.col("leaves") + F.col("ends_here").cast("long"))
    whole = scratch(whole.select("*", "_parent.parent_hi", "_parent.parent_lo").drop("_parent"))
    parent = ["parent_hi", "parent_lo"]
    kids = whole.filter("parent_hi is not null").groupBy(*parent).agg(F.count("*").alias("_kids")).toDF("hi", "lo", "_kids")
    state = whole.select("hi", "lo", *parent, "saved", "leaves")
    while state.filter("parent_hi is not null").head(1):
        moved = state.filter("parent_hi is not null")
        sums = moved.groupBy(*parent).agg(F.sum("saved").alias("_saved"), F.sum("leaves").alias("_leaves")).toDF("hi", "lo", "_saved", "_leaves")
        jumps = state.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("parent_hi").alias("_hi"), F.col("parent_lo").alias("_lo"))
        tops = state.filter("parent_hi is null").withColumns({"_hi": F.lit(None).cast("long"), "_lo": F.lit(None).cast("long")})
        jumped = moved.join(jumps, parent).unionByName(tops).drop(*parent).withColumnsRenamed({"_hi": "parent_hi", "_lo": "parent_lo"})
        state = jumped.join(sums, ["hi", "lo"], "left")
        state = scratch(
            state.select(
                "hi", "lo", *parent, (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("_leaves", F.lit(0))).alias("leaves")
            )
        )
    sums = state.select("hi", "lo", F.col("saved").alias("_saved"), F.col("leaves").alias("_leaves"))
    done = whole.join(sums, ["hi", "lo"]).join(kids, ["hi", "lo"], "left")
    return scratch(
        done.select(
            "hi", "lo", *parent, "depth", "conv_id", "n_convs", (F.col("children") + F.coalesce("_kids", F.lit(0))).alias("n_children"),
            F.col("_leaves").alias("n_leaves"), (F.col("rest") + F.col("_saved")).alias("saved_tokens"),
        )
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each node; rows come sorted by node and id, and only one digest is open."""
    now, digest = None, None
    done: list[tuple[int, int, str]] = []
    for batch in batches:
        hi, lo, conv = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(hi):
            continue
        new = np.ones(len(hi), dtype=bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        cuts = np.append(np.flatnonzero(new), len(hi))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            ids = ",".join(map(str, conv[a:b].tolist())).encode()
            if now == (hi[a], lo[a]):
                digest.update(b"," + ids)
                continue
            if now is not None:
                done.append((*now, digest.hexdigest()))
            now, digest = (hi[a], lo[a]), hashlib.sha256(ids)
        if len(done) > 10_000:
            yield _digest_rows(done)
            done = []
    if now is not None:
        done.append((*now, digest.hexdigest()))
    yield _digest_rows(done)


def _digest_rows(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = [pa.array([int(d[0]) for d in done], pa.int64()), pa.array([int(d[1]) for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())]
    return pa.record_batch(columns, names=["hi", "lo", "ends_sha256"])


def prefix_trie(turns: DataFrame, lengths: DataFrame, stretch: int = STRETCH, columns: int = COLUMNS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of conversations given as ``turns`` (``conv_id, place, hi, lo, size``) and ``lengths`` (``conv_id, total``).

    Places run from 1 without a gap; ``hi, lo`` stand for role and text; ``total`` is the number of turns, 0 for
    a conversation without any. See ``rebuilt_trie`` for the columns. ``stretch`` and ``columns`` bound a shard's
    matrix; they change no result.
    """
    rows = scratch(_stretches(turns, lengths, stretch))
    shards = pieces_for(rows.count(), shard_rows)
    ids = F.transform("turns", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"))).alias("_ids")
    keyed = rows.select("conv_id", "level", "key_hi", "key_lo", "turns", "goes_on", ids)
    ranged = keyed.repartitionByRange(shards, "level", "key_hi", "key_lo", "_ids", "conv_id").drop("_ids")
    nodes = scratch(ranged.mapInArrow(_sharder(stretch, columns), _NODE))
    edges = _add_up(nodes.filter("edge"))
    tops = edges.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("_above"))
    inner = nodes.filter("not edge").withColumnsRenamed({"children": "n_children", "leaves": "n_leaves"}).withColumn("saved_tokens", F.col("rest") - F.col("distinct"))
    shown = ["hi", "lo", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    near = inner.filter("not parent_edge").withColumnRenamed("parent_conv", "parent_conv_id").select(*shown)
    below = inner.filter("parent_edge").join(tops, ["parent_hi", "parent_lo"]).withColumnRenamed("_above", "parent_conv_id").select(*shown)
    held = edges.filter("parent_hi is not null").join(tops, ["parent_hi", "parent_lo"]).withColumnRenamed("_above", "parent_conv_id").select(*shown)
    root = edges.filter("parent_hi is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*shown)
    every = near.unionByName(below).unionByName(held).unionByName(root)

    ends = [F.col(f"key_{x}").bitwiseXOR(F.col(f"sum_{x}")).alias(x) for x in ("hi", "lo")]
    ended = rows.filter("not goes_on").select(*ends, "conv_id").repartition("hi", "lo").sortWithinPartitions("hi", "lo", "conv_id")
    digests = ended.mapInArrow(_digests, "hi long, lo long, ends_sha256 string")
    empty = F.sha2(F.lit(""), 256)
    return every.join(digests, ["hi", "lo"], "left").select(*shown[2:], F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def rebuilt_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **bounds: int
) -> DataFrame:
    """The trie of rebuilt conversations, one row a node, the root included.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (bytes of
    text that members share with another one, summed over the subtree), ``ends_sha256`` (digest of the ids of the
    conversations that end here, ascending, joined by commas). ``conv_id`` and ``depth`` together name a node.

    Turns stand in the order of ``turn``, null first; turns of one number follow each other in the order of a
    hash of role and text, the same at every run. A null role or text counts as empty. Rows without a ``conv_id``
    belong to no conversation. Repeated rows are turns of their own. A conversation that has no turn left after it
    is rebuilt ends at the root. An empty table has no conversations and gives no node. Other columns are left out.
    ``bounds`` are those of ``prefix_trie``.
    """
    ship(conversations.sparkSession)
    turns, lengths = rebuilt_turns(conversations, conv_id, turn, role, text)
    return prefix_trie(turns, lengths, **bounds)
