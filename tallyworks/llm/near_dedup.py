"""Near-duplicate documents by MinHash signatures joined through an inverted index of coordinates.

Equal shingle sets are one class from the start, named by a hash of the set; ids are no part of the search. Each class posts its signature as 64 tokens, a
coordinate and its value. Two signatures with at least ``t`` equal coordinates share one of the
``m - t + 1`` rarest of either's tokens, so only that prefix is posted; the frequent tokens behind it
are skipped in the index and counted straight from the signatures. Lists give clusters of classes
that may be alike, by one link to a leader per entry. Within a cluster, blocks of bounded size count
equal coordinates pair by pair inside one task, retain pairs from ``t`` on, and confirm each on the
full shingle sets unless its ends are connected already; a block reports a spanning forest, never its
pairs. Clusters of several blocks get a second turn between blocks, but only for classes outside the
cluster's main component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.learning import text_column, with_last
from tallyworks.llm.shared import FILE_ROWS, LAST_ID, components, pieces_for, release, scratch, ship
from tallyworks.llm.token_ids import filled_ids
from tallyworks.llm.words import chunks, constants, mix, text_bytes, words_of
from tallyworks.operators.joins import join_hot

COORDINATES = 64
BLOCK_SHINGLES = 200_000
_LINK = "a long, b long"
_LOW = np.uint64((1 << 48) - 1)


def match_threshold(coordinates: int, likeness: float, miss: float = 1e-6) -> int:
    """The most equal coordinates to ask for such that a pair of that likeness falls short with chance ``miss`` at most."""
    below, t = 0.0, 0
    while t < coordinates:
        below += comb(coordinates, t) * likeness**t * (1 - likeness) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def shingle_sets(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, as 48-bit hashes: all values in text order, and how many each text has.

    A text with fewer than ``size`` words has its whole word sequence as one shingle.
    """
    words = words_of(texts, lower=True)
    counts = words.counts
    hashed, inside = words.windows(size, size)
    owner, values = words.owner[inside], hashed[inside]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            whole, _ = words.windows(n, n)
            owner = np.concatenate([owner, short])
            values = np.concatenate([values, whole[words.first[short]]])
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (values & _LOW))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    sizes = np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=len(texts))
    return keys & _LOW, sizes


def signatures(values: np.ndarray, sizes: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash signature of each non-empty set, one row each."""
    full = sizes[sizes > 0]
    out = np.zeros((len(full), coordinates), dtype=np.uint32)
    if len(full):
        starts = np.cumsum(full) - full
        spread = mix(values)
        for k, c in enumerate(constants(coordinates, 77)):
            out[:, k] = np.minimum.reduceat(((spread * c) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def set_keys(values: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A 128-bit key of each set, null for empty ones."""
    some = np.flatnonzero(sizes)
    keys: list[bytes | None] = [None] * len(sizes)
    if len(some):
        starts = np.cumsum(sizes[some]) - sizes[some]
        one = np.add.reduceat(mix(values), starts)
        two = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
        for i, at in enumerate(some):
            keys[at] = int(one[i]).to_bytes(8, "little") + int(two[i]).to_bytes(8, "little")
    return keys


def keyed(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``docs`` with ``_set_key``, the key that ``sign`` gives to each text."""
    ship(docs.sparkSession)

    def key(texts: list[bytes | None]) -> pa.Array:
        return pa.array(set_keys(*shingle_sets(texts, shingle)), pa.binary())

    return with_last(docs, _set_key=text_column(key, "binary", text))


def sign(docs: DataFrame, shingle: int, coordinates: int = COORDINATES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, set_key, signature``; key and signature are null for texts without words."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                values, sizes = shingle_sets(text_bytes(part.column(text)), shingle)
                some = np.flatnonzero(sizes)
                rows = signatures(values, sizes, coordinates)
                keys = set_keys(values, sizes)
                signed: list[bytes | None] = [None] * len(sizes)
                for i, at in enumerate(some):
                    signed[at] = rows[i].tobytes()
                ids = pa.array(filled_ids(part.column(doc_id), LAST_ID))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signed, pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "signature"],
                )
            release()

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _tokens(classes: DataFrame) -> DataFrame:
    """One row for each class and coordinate: ``rep``, ``token`` (coordinate and value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint32).reshape(part.num_rows, -1)
                token = rows.astype(np.int64) | (np.arange(rows.shape[1], dtype=np.int64) << 32)
                reps = np.repeat(part.column(0).to_numpy(), rows.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(token.ravel())], names=["rep", "token"])

    return classes.select("rep", "signature").mapInArrow(run, "rep long, token long")


def postings(classes: DataFrame, t: int) -> DataFrame:
    """The prefix of each class, ``rep, token``, and ``score``: how often its tokens occur in all."""
    tokens = _tokens(classes)
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    shared = join_hot(tokens, counts, "token")
    own = Window.partitionBy("rep")
    ranked = shared.select(
        "rep",
        "token",
        F.row_number().over(own.orderBy("n", "token")).alias("rank"),
        F.count("*").over(own).alias("m"),
        F.sum("n").over(own).alias("score"),
    )
    return ranked.filter(F.col("rank") <= F.col("m") - t + 1).select("rep", "token", "score")


class _Forest:
    """Union-find over the rows of a block."""

    def __init__(self, labels: np.ndarray):
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        self.parent = first[inverse]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.root(int(i)) for i in rows], dtype=np.int64)

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def _block_verifier(shingle: int, percent: int, t: int, across: bool) -> Callable[[pa.Table], pa.Table]:
    """Links of one block. ``across``: only between rows that ask (``side`` 1) and the others."""

    def verify(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_numpy()
        _, chosen = np.unique(np.stack([reps, table.column("side").to_numpy()]), axis=1, return_index=True)
        cluster = table.column("component").to_numpy()[chosen]
        order = np.argsort(cluster, kind="stable")
        chosen, cluster = chosen[order], cluster[order]
        table = table.take(pa.array(chosen))
        reps, side = table.column("rep").to_numpy(), table.column("side").to_numpy()
        signed = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint32).reshape(len(reps), -1)
        forest = _Forest(table.column("label").to_numpy())
        sets: list[np.ndarray] | None = None
        links: list[tuple[int, int]] = []
        ends = np.searchsorted(cluster, cluster, side="right")
        begins = np.searchsorted(cluster, cluster, side="left")
        for i in range(len(reps)):
            if across and not side[i]:
                continue
            rows = np.arange(begins[i] if across else i + 1, ends[i])
            if across:
                rows = rows[side[rows] == 0]
            rows = rows[(signed[rows] == signed[i]).sum(axis=1) >= t]
            rows = rows[forest.roots(rows) != forest.root(i)]
            if not len(rows):
                continue
            if sets is None:
                values, sizes = shingle_sets(text_bytes(table.column("text")), shingle)
                _, number = np.unique(values, return_inverse=True)
                flags = np.zeros(int(number.max()) + 1 if len(number) else 1, dtype=bool)
                sets = np.split(number, np.cumsum(sizes)[:-1])
            flags[sets[i]] = True
            lengths = np.array([len(sets[j]) for j in rows])
            both = np.add.reduceat(flags[np.concatenate([sets[j] for j in rows])].astype(np.int64), np.cumsum(lengths) - lengths)
            flags[sets[i]] = False
            for j in rows[100 * both >= percent * (len(sets[i]) + lengths - both)]:
                if forest.root(i) != forest.root(int(j)):
                    forest.join(i, int(j))
                    links.append((int(reps[i]), int(reps[j])))
        release()
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return verify


def _links(docs: DataFrame, classes: DataFrame, shingle: int, percent: int, t: int, block_shingles: int, files: int) -> DataFrame:
    """Confirmed links between classes that connect what all confirmed links together would."""
    posted = scratch(postings(classes, t), files)
    leads = posted.groupBy("token").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).filter("n > 1")
    near = components(join_hot(posted, leads, "token").select(F.col("rep").alias("a"), F.col("lead").alias("b")), most=posted.count())
    scores = posted.groupBy("rep").agg(F.max("score").alias("score"))
    members = near.select(F.col("node").alias("rep"), "component").join(classes.select("rep", "least", "n", "signature"), "rep").join(scores, "rep", "left")
    sizes = members.groupBy("component").agg(F.sum("n").alias("total"), F.max(F.struct("score", "rep")).alias("lead"))
    placed = join_hot(members, sizes, "component").withColumn("blocks", F.ceil(F.col("total") / block_shingles))
    placed = scratch(placed.select("rep", "least", "component", "blocks", "signature", F.col("lead.rep").alias("lead")), files)
    of_id = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("least"), "text")
    texts = keyed(join_hot(of_id, placed.select("least").distinct(), "least", "left_semi"), shingle).withColumn("rep", F.xxhash64("_set_key"))
    one_each = Window.partitionBy("rep").orderBy(F.octet_length("text"))
    texts = texts.filter("_set_key is not null").withColumn("_turn", F.row_number().over(one_each)).filter("_turn = 1").select("rep", "text")
    held = scratch(texts.join(placed.drop("least"), "rep"), files)

    small, large = held.filter("blocks = 1"), held.filter("blocks > 1")
    bins = small.groupBy().agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"] // (6 * block_shingles) + 1
    one = small.select("*", F.lit(-1).cast("long").alias("big"), F.pmod(F.xxhash64("component"), F.lit(bins)).alias("block"))
    spread = large.withColumn("big", F.col("component")).withColumn(
        "block",
        F.explode(F.when(F.col("rep") == F.col("lead"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep"), "blocks")))),
    )
    columns = ["big", "block", "rep", "component", "signature", "text"]
    alone = one.select(columns).unionByName(spread.select(columns)).withColumn("label", F.col("rep")).withColumn("side", F.lit(0))
    first = scratch(alone.groupBy("big", "block").applyInArrow(_block_verifier(shingle, percent, t, False), _LINK))
    if large.isEmpty():
        return first

    labels = components(first, most=first.count()).select(F.col("node").alias("rep"), F.col("component").alias("label"))
    named = large.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")).withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
    common = named.groupBy("component", "label").agg(F.count("*").alias("k"), F.max("blocks").alias("blocks"))
    main = common.groupBy("component").agg(F.max(F.struct("k", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    told = join_hot(named, main.select("component", F.col("main.label").alias("main")), "component")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    asking = told.filter("label <> main").withColumn("i", F.col("own")).withColumn("j", F.explode(every)).withColumn("side", F.lit(1))
    blocks_asking = told.filter("label <> main").select("component", F.col("own").alias("i")).distinct()
    asked = join_hot(told, blocks_asking, "component").withColumn("j", F.col("own")).withColumn("side", F.lit(0))
    columns = ["component", "i", "j", "rep", "label", "side", "signature", "text"]
    pairs = asking.select(columns).unionByName(asked.select(columns)).filter("i <> j")
    second = pairs.groupBy("component", "i", "j").applyInArrow(_block_verifier(shingle, percent, t, True), _LINK)
    return first.unionByName(scratch(second))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    text: str = "text",
    doc_id: str = "doc_id",
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Words are lower-cased in A-Z; a document's set is its distinct shingles of ``shingle`` words, its
    whole word sequence if that is shorter. Two documents are linked if 100 times their sets'
    intersection is at least ``percent`` times their union; ``component_id`` is the smallest ``doc_id``
    reachable over links and ``kept`` marks that document. Every link is confirmed on full sets; a link
    at the threshold is missed with chance 1e-6.

    Null texts and texts without words have empty sets and are linked with nothing. Rows are linked by
    their texts, whatever their ids: rows with one ``doc_id``, or none, and different texts may belong to
    different components, and of those that share a component and its smallest id the rows of one text
    are kept. Each row is returned. A null ``doc_id`` counts as the largest, and comes back null. An
    empty table gives an empty table; other columns are left out.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies above 0 and up to 100")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed, of_class, files = _placed(docs, shingle, percent, coordinates, block_shingles)
    out = join_hot(signed.select("doc_id", "n_shingles", "set_key"), of_class, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return out.coalesce(files).select(
        F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif(component, F.lit(LAST_ID)).alias("component_id"),
        ((F.col("doc_id") == component) & F.coalesce("chosen", F.lit(True))).alias("kept"),
    )


def _placed(docs: DataFrame, shingle: int, percent: int, coordinates: int, block_shingles: int) -> tuple[DataFrame, DataFrame, int]:
    """The signed rows, of each set its component's smallest id and whether the set is the one ``chosen`` from it, and how many files they are worth."""
    t = match_threshold(coordinates, percent / 100)
    signed = scratch(sign(docs, shingle, coordinates))
    files = pieces_for(signed.count(), FILE_ROWS)
    classes = scratch(
        signed.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.max("signature").alias("signature"))
        .withColumn("rep", F.xxhash64("set_key")),
        files,
    )
    links = _links(docs, classes, shingle, percent, t, block_shingles, files)
    found = components(links, most=links.count()).select(F.col("node").alias("rep"), F.col("component").alias("group"))
    grouped = classes.select("set_key", "rep", "least").join(found, "rep", "left").withColumn("group", F.coalesce("group", "rep"))
    tops = grouped.groupBy("group").agg(F.min(F.struct("least", "rep")).alias("top"))
    of_class = join_hot(grouped, tops, "group")
    of_class = of_class.select("set_key", F.col("top.least").alias("component"), (F.col("rep") == F.col("top.rep")).alias("chosen"))
    return signed, scratch(of_class, files), files


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    text: str = "text",
    doc_id: str = "doc_id",
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, of those with the smallest ``doc_id``; rows without words all stay."""
    if not 0 < percent <= 100:
        raise ValueError("percent lies above 0 and up to 100")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed, of_class, files = _placed(own, shingle, percent, coordinates, block_shingles)
    out = join_hot(signed.select("doc_id", "set_key"), of_class, "set_key", "left")
    kept = out.filter(F.col("set_key").isNull() | F.col("chosen") & (F.col("doc_id") == F.col("component")))
    counts = signed.groupBy(F.col("doc_id").alias("_kept_id")).agg(F.count("*").alias("_n"))
    several = scratch(counts.filter("_n > 1").select("_kept_id"), files)
    named = docs.withColumn("_kept_id", F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)))
    single = kept.select(F.col("doc_id").alias("_kept_id")).join(several, "_kept_id", "left_anti").distinct()
    done = named.join(single, "_kept_id", "left_semi").select(*docs.columns).coalesce(files)
    if several.isEmpty():
        return done

    # An id of several rows does not tell which is meant: these rows are told apart by their texts.
    rows = keyed(join_hot(named, several, "_kept_id", "left_semi"), shingle, text)
    bare = rows.filter("_set_key is null").select(*docs.columns)
    chosen = of_class.filter("chosen").select(F.col("set_key").alias("_set_key"), F.col("component").alias("_kept_id"))
    met = join_hot(rows.filter("_set_key is not null"), chosen.withColumnRenamed("_kept_id", "_top_id"), "_set_key").filter("_kept_id = _top_id")
    turn = F.row_number().over(Window.partitionBy("_set_key").orderBy("_kept_id"))
    one_each = met.withColumn("_turn", turn).filter("_turn = 1").select(*docs.columns)
    return done.unionByName(bare).unionByName(one_each)
