"""Substring dedup by level-wise doubling: only what repeats at one length is looked at at twice that length.

Lengths run up to the wanted window by halving it (13 words: 7, then 13). At the first length a
window of the next length is stood for by the smallest hash among the short windows in it, so that a
quarter of all places is posted; equal long windows have equal shortest ones, so none is lost.
Short windows that repeat let the long windows over them through, and those that repeat go on to the
next length, until the wanted length or no candidate is left. A repeat longer than the window is
covered by windows of that length, so longer levels would not change which words go.

Work is dealt by document group. A group posts each distinct window hash once, however often and in
however many of its documents it occurs, so a passage that a third of all documents share costs one
entry a group. What comes back is one bit an entry. Texts are shuffled once; each level reads that
shuffle again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.shared import LAST_ID, pieces_for, release, ship, text_size, with_fields
from tallyworks.llm.words import Words, text_bytes, words_of

GROUP_BYTES = 4 << 20
BUCKET_ENTRIES = 1 << 20
SHORTEST = 7

_GROUP = "_sub_group"
_POSTED = "bucket long, _sub_group long, keys binary, docs binary"
_ANSWER = "_sub_group long, level int, bucket long, n int, bits binary"


def level_lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths by level, each at most twice the one before; the last is ``window``."""
    lengths = [window]
    while lengths[-1] > shortest:
        lengths.append((lengths[-1] + 1) // 2)
    return lengths[::-1]


def _per_key(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of each row's key among them, and each key's smallest and largest document."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    if not len(keys):
        return keys, place, docs, docs
    by_key = docs[order]
    return ordered[starts], place, np.minimum.reduceat(by_key, starts), np.maximum.reduceat(by_key, starts)


def _bits(answers: pa.Table, level: int) -> np.ndarray:
    """The bits of one level in key order: buckets hold ascending ranges of keys."""
    rows = sorted((r for r in answers.select(["level", "bucket", "n", "bits"]).to_pylist() if r["level"] == level), key=lambda r: r["bucket"])
    parts = [np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), count=r["n"]) for r in rows]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, dtype=bool)


class _Group:
    """The windows of one group of documents, level by level."""

    def __init__(self, ids: np.ndarray, texts: list[bytes | None], lengths: list[int], whole: bool = True):
        """``whole``: the texts and the places of the words in them are kept, not only the words' hashes."""
        self.words: Words = words_of(texts)
        if not whole:
            self.words.data = self.words.start = self.words.end = self.words.hash[:0]
        self.doc = ids[self.words.owner]
        self.lengths = lengths
        self.alive = np.zeros(len(self.doc), dtype=bool)

    def _candidates(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Places that this level looks at, and the hash that stands for each."""
        length = self.lengths[level]
        if level == 0 and len(self.lengths) > 1:
            longer = self.lengths[1]
            hashed, _ = self.words.windows(length, length)
            _, inside = self.words.windows(longer, longer)
            least = hashed.copy()
            for step in range(1, longer - length + 1):
                most = max(0, len(least) - step)
                np.minimum(least[:most], hashed[step:], out=least[:most])
            places = np.flatnonzero(inside)
            return places, least[places]
        hashed, inside = self.words.windows(length, length)
        if level == 0:
            places = np.flatnonzero(inside)
        elif level == 1:
            places = np.flatnonzero(self.alive)
        else:
            step = length - self.lengths[level - 1]
            most = max(0, len(self.alive) - step)
            both = np.zeros(len(self.alive), dtype=bool)
            both[:most] = self.alive[:most] & self.alive[step:]
            places = np.flatnonzero(both & inside)
        return places, hashed[places]

    def keys(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of a level in ascending order, each with its smallest document here."""
        self.places, keys = self._candidates(level)
        self.distinct, self.place, self.least, self.most = _per_key(keys, self.doc[self.places])
        return self.distinct, self.least

    def settle(self, bits: np.ndarray, last: bool) -> None:
        """Take in what the other groups have: which places repeat (on the last level: in a smaller document)."""
        if last:
            repeats = (self.doc[self.places] > self.least[self.place]) | bits[self.place]
        else:
            repeats = ((self.most > self.least) | bits)[self.place]
        self.alive = np.zeros(len(self.doc), dtype=bool)
        self.alive[self.places[repeats]] = True


def _ids(table: pa.Table, column: str) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(table.column(column).cast(pa.int64()), LAST_ID).to_numpy()


def _poster(doc_id: str, text: str, lengths: list[int], level: int, bits: int) -> Callable:
    """Posts a group's windows of ``level`` by bucket, once the answers to the levels before are in."""

    def post(table: pa.Table, answers: pa.Table | None) -> pa.Table:
        group = _Group(_ids(table, doc_id), text_bytes(table.column(text)), lengths, False)
        for earlier in range(level):
            group.keys(earlier)
            group.settle(_bits(answers, earlier), False)
        keys, least = group.keys(level)
        buckets = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, dtype=np.int64)
        last = level == len(lengths) - 1
        number = table.column(_GROUP)[0].as_py() if len(table) else 0
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        del group
        release()
        return pa.table(
            {
                "bucket": pa.array([int(buckets[s]) for s, _ in spans], pa.int64()),
                _GROUP: pa.array([number] * len(spans), pa.int64()),
                "keys": pa.array([keys[s:e].tobytes() for s, e in spans], pa.binary()),
                "docs": pa.array([least[s:e].tobytes() if last else b"" for s, e in spans], pa.binary()),
            }
        )

    return post


def _alone(post: Callable) -> Callable[[pa.Table], pa.Table]:
    """The first level has no answers to wait for."""

    def first(table: pa.Table) -> pa.Table:
        return post(table, None)

    return first


def _answerer(level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    """For each posted entry of a bucket: does another group have it (on the last level: in a smaller document)?"""

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k.as_py(), dtype=np.uint64) for k in table.column("keys")]
        sizes = [len(k) for k in keys]
        every = np.concatenate(keys)
        if last:
            docs = np.concatenate([np.frombuffer(d.as_py(), dtype=np.int64) for d in table.column("docs")])
            _, place, least, _ = _per_key(every, docs)
            hit = docs > least[place]
        else:
            _, place, counts = np.unique(every, return_inverse=True, return_counts=True)
            hit = (counts > 1)[place]
        ends = np.cumsum(sizes)
        return pa.table(
            {
                _GROUP: table.column(_GROUP),
                "level": pa.array([level] * len(sizes), pa.int32()),
                "bucket": table.column("bucket"),
                "n": pa.array(sizes, pa.int32()),
                "bits": pa.array([np.packbits(hit[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary()),
            }
        )

    return answer


def _kept_text(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    data = np.append(words.data, np.uint8(32))
    owner, start, end = words.owner[kept], words.start[kept], words.end[kept]
    last = np.ones(len(owner), dtype=bool)
    last[:-1] = owner[1:] != owner[:-1]
    end = end + ~last
    edges = np.zeros(len(data) + 1, dtype=np.int8)
    edges[start] += 1
    edges[end] -= 1
    chosen = data[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)]
    chosen[(chosen >= 9) & (chosen <= 13)] = 32
    sizes = np.bincount(owner, weights=end - start, minlength=len(words.counts)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(chosen)).cast(pa.string())


def _finisher(doc_id: str, text: str, lengths: list[int], schema: T.StructType, keep_layout: bool) -> Callable:
    names = schema.fieldNames()
    window = lengths[-1]

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Group(_ids(table, doc_id), text_bytes(table.column(text)), lengths, True)
        for level in range(len(lengths)):
            group.keys(level)
            group.settle(_bits(answers, level), level == len(lengths) - 1)
        cover = np.zeros(len(group.doc) + 1, dtype=np.int64)
        places = np.flatnonzero(group.alive)
        cover[places] += 1
        np.subtract.at(cover, places + window, 1)
        gone = np.cumsum(cover[:-1]) > 0
        removed = np.bincount(group.words.owner[gone], minlength=len(table))
        new = _kept_text(group.words, ~gone)
        if keep_layout:
            import pyarrow.compute as pc

            new = pc.if_else(pa.array(removed > 0), new, table.column(text).combine_chunks().cast(pa.string()))
        made = {"n_words": pa.array(group.words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), text: new}
        del group
        release()
        return pa.table({n: made.get(n, table.column(n) if n not in made else None) for n in names})

    return finish


def dedup_substrings(
    docs: DataFrame,
    window: int = 13,
    text: str = "text",
    doc_id: str = "doc_id",
    keep_layout: bool = True,
    group_bytes: int = GROUP_BYTES,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """``docs`` without the words that repeat an earlier document, plus ``n_words`` and ``n_removed``.

    A word goes if one of the windows of ``window`` words over it also starts in a document with a
    smaller ``doc_id``; all windows are taken from the input. The first copy therefore stays. Kept
    words are joined by one space; a text that loses nothing stays as it is unless ``keep_layout`` is
    false. Other columns stay, except that input columns named ``n_words`` or ``n_removed`` give way.

    Null and empty texts, and those shorter than a window, lose nothing (with ``keep_layout`` false a
    null text becomes empty). A null ``doc_id`` counts as the largest. Rows with the same ``doc_id``
    never remove each other's words. An empty table gives an empty table. Equal words are equal byte
    for byte; windows are compared by 64-bit hashes at every level.
    """
    ship(docs.sparkSession)
    lengths = level_lengths(window)
    size = text_size(docs, text)
    groups = pieces_for(size, group_bytes)
    bits = max(0, (pieces_for(size // 24, bucket_entries) - 1).bit_length())
    dealt = docs.withColumn(_GROUP, F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(LAST_ID)), F.coalesce(F.octet_length(text), F.lit(0))), F.lit(groups)))
    schema = with_fields(docs.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()))
    answers: DataFrame | None = None
    for level in range(len(lengths)):
        post = _poster(doc_id, text, lengths, level, bits)
        if answers is None:
            posted = dealt.groupBy(_GROUP).applyInArrow(_alone(post), _POSTED)
        else:
            posted = dealt.groupBy(_GROUP).cogroup(answers.groupBy(_GROUP)).applyInArrow(post, _POSTED)
        answer = posted.groupBy("bucket").applyInArrow(_answerer(level, level == len(lengths) - 1), _ANSWER)
        answers = answer if answers is None else answers.unionByName(answer)
    finish = _finisher(doc_id, text, lengths, schema, keep_layout)
    return dealt.groupBy(_GROUP).cogroup(answers.groupBy(_GROUP)).applyInArrow(finish, schema)
