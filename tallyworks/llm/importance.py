"""Resampling documents towards a target distribution of hashed n-grams, weighed by importance.

Each text is scanned once. Its words, lower-cased and put one space apart, are run through CRC-32 and the
running value is kept after every word. The value of any n-gram follows from two of these: as CRC-32 is
linear over GF(2), crc(AB) = shift(crc(A), |B|) xor crc(B), so the prefix before the n-gram is shifted by
the n-gram's bytes and cancelled from the prefix behind it. Shifts are table look-ups for the powers of
two in the number of bytes, for all n-grams of many texts at a time.

What is kept of a text is its features' buckets, two bytes each. Bucket counts of either side are one
row a bucket, whatever the corpus holds; they are the only thing that comes to the driver. Ranks are
given range by range, so no task sorts all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import numbered, rule_column, scratch, ship
from tallyworks.llm.words import chunks, text_bytes

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20

_POLYNOMIAL = 0xEDB88320
# A-Z to lower case; every other ASCII character that is neither a digit nor a letter to a space.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_tables: dict[str, np.ndarray] = {}


def _byte_table() -> np.ndarray:
    """The CRC register after one byte, for each value of its low byte."""
    if "byte" not in _tables:
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
        _tables["byte"] = table
    return _tables["byte"]


def after_byte(crc: np.ndarray, byte: int) -> np.ndarray:
    """CRC-32 of each text with one more byte behind it."""
    register = ~crc
    return ~(_byte_table()[(register ^ np.uint32(byte)) & np.uint32(255)] ^ (register >> np.uint32(8)))


def _apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by its images of each byte in each of the four places."""
    out = table[0][values & np.uint32(255)]
    for place in range(1, 4):
        out = out ^ table[place][(values >> np.uint32(8 * place)) & np.uint32(255)]
    return out


def _shift_table(power: int) -> np.ndarray:
    """The map that appends 2**power zero bytes to a CRC register."""
    name = f"shift{power}"
    if name not in _tables:
        if power == 0:
            values = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
            _tables[name] = _byte_table()[values & np.uint32(255)] ^ (values >> np.uint32(8))
        else:
            half = _shift_table(power - 1)
            _tables[name] = _apply(half, half.reshape(-1)).reshape(4, 256)
    return _tables[name]


def shifted(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What CRC-32 values turn into when ``n_bytes`` bytes follow: one look-up a set bit of that number."""
    out = crc.copy()
    for power in range(int(n_bytes.max()).bit_length() if len(n_bytes) else 0):
        at = np.flatnonzero((n_bytes >> power) & 1)
        out[at] = _apply(_shift_table(power), out[at])
    return out


def substring_crc(before: np.ndarray, behind: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of the ``n_bytes`` bytes between two places, from the running values at both."""
    return shifted(before, n_bytes) ^ behind


def text_features(texts: list[bytes | None], longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, features of each text, and the CRC-32 of all features, text by text."""
    split = [t.translate(_NORMAL).split() if t else [] for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    words = [w for ws in split for w in ws]
    # one scan: a space before each word, the running value after it
    behind = np.fromiter((c for ws in split for c in _running(ws)), dtype=np.uint32, count=len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.ones(len(words), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    ahead = np.zeros(len(words), dtype=np.uint32)
    ahead[1:] = behind[:-1]
    ahead[first] = 0
    before = after_byte(ahead, 32)
    made, owners, width = [], [], sizes.copy()
    for n in range(1, longest + 1):
        m = len(words) - n + 1
        if m < 1:
            break
        if n > 1:
            width = width[:m] + 1 + sizes[n - 1 :]
        inside = np.flatnonzero(owner[:m] == owner[n - 1 :])
        made.append(substring_crc(before[inside], behind[inside + n - 1], width[inside]))
        owners.append(owner[inside])
    if not made:
        return counts, np.zeros(len(texts), dtype=np.int64), np.zeros(0, dtype=np.uint32)
    owners, made = np.concatenate(owners), np.concatenate(made)
    order = np.argsort(owners, kind="stable")
    return counts, np.bincount(owners, minlength=len(texts)), made[order]


def _running(words: list[bytes]) -> Iterator[int]:
    """CRC-32 after each word of a text, each with a space before it."""
    crc = 0
    for word in words:
        crc = crc32(b" " + word, crc)
        yield crc


def _featurizer(text: str, buckets: int, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                n_words, n_features, crcs = text_features(text_bytes(part.column(text)), longest)
                found = (crcs % np.uint32(buckets)).astype("<u4" if buckets > 1 << 16 else "<u2")
                ends = np.concatenate([[0], np.cumsum(n_features)]) * found.itemsize
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n_words), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(found.tobytes())])
                yield pa.record_batch(
                    [part.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), data.cast(pa.binary())],
                    names=["_id", "n_words", "n_features", "_buckets"],
                )

    return make


def features(docs: DataFrame, text: str, doc_id: str | None, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``_id, n_words, n_features, _buckets`` of each text, written to the scratch folder."""
    known = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    rows = docs.select(known.alias("_id"), F.col(text).cast("string").alias("_text"))
    made = rows.mapInArrow(_featurizer("_text", buckets, longest), "_id long, n_words long, n_features long, _buckets binary")
    return scratch(made)


def _unpacked(batch: pa.RecordBatch, buckets: int) -> np.ndarray:
    """The buckets of all rows of a batch, end to end."""
    column = batch.column(batch.schema.get_field_index("_buckets")).cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    kind = np.dtype("<u4" if buckets > 1 << 16 else "<u2")
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view(kind) if ends[-1] > ends[0] else np.zeros(0, dtype=kind)


def bucket_counts(made: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket: counted in every task, added by bucket, one row a bucket in the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch, buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    counted = made.select("_buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of log likelihood by which each bucket speaks for the target, add-one smoothed, rounded down."""
    size = float(len(source))
    ratio = (target + 1.0) * (source.sum() + size) / ((source + 1.0) * (target.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigher(gain: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            values = np.concatenate([[0], np.cumsum(gain[_unpacked(batch, len(gain))])])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            sums = values[ends[1:]] - values[ends[:-1]]
            weight = np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)
            yield pa.record_batch([*batch.columns[:3], pa.array(weight, pa.int64())], names=["_id", "n_words", "n_features", "weight"])

    return weigh


def resample(
    docs: DataFrame,
    target: DataFrame,
    seed: str = "7",
    percent: int = 25,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    text: str = "text",
    doc_id: str = "doc_id",
    target_text: str = "text",
) -> DataFrame:
    """One row a document, ``doc_id, n_words, n_features, weight, score, rank``; ``rank`` is null if it is not drawn.

    Words are runs of ASCII letters and digits and of any other characters beyond ASCII, A-Z lower-cased;
    features all runs of one to ``longest`` words, hashed to ``buckets`` by CRC-32. ``weight`` is the mean gain of a
    document's features, rounded down (0 without features), in thousandths; ``score`` adds Gumbel noise drawn
    from SHA-256 of ``seed:doc_id``, so the highest scores are a sample without replacement by importance.
    Drawn are ``percent`` % (rounded down) of the documents with ``least_words`` words or more, ranked from 1
    by falling score, then by smaller ``doc_id``.

    Null and empty texts have no words: weight 0, never drawn. A null ``doc_id`` is seeded as ``seed:`` and
    counts as the largest. Rows with one ``doc_id`` are weighed and ranked each by itself; equal rows take
    ranks in turn. An empty table gives an empty one; with an empty target all counts of it are 0. Other
    columns are left out.
    """
    ship(docs.sparkSession)
    made = features(docs, text, doc_id, buckets, longest)
    aim = features(target, target_text, None, buckets, longest)
    gain = gains(bucket_counts(made, buckets), bucket_counts(aim, buckets))
    weighed = made.mapInArrow(_weigher(gain), "_id long, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((drawn + 0.5) / 4294967296.0)))
    scored = scratch(weighed.withColumn("score", (F.col("weight") + noise).cast("long")))
    fit = rule_column(F.col("n_words") >= least_words)
    eligible = scored.filter(fit)
    most = eligible.count() * percent // 100
    placed = numbered(eligible, [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("weight"), F.col("n_features"), F.col("n_words")], "_place")
    rank = F.when(F.col("_place") < most, F.col("_place") + 1)
    ranked = placed.withColumn("rank", rank).drop("_place")
    rest = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("_id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")
