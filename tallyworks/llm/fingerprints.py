"""SimHash fingerprints with DataFrame functions only, and the search for all near ones.

The terms of a text are its pairs of neighbouring words (a last or only word stands alone). Each term
is hashed to 64 bits and votes for each bit, with the number of its bytes (32 at most) as weight, so
runs of short function words count little. A bit is set if more than half of all weight is for it.
Two counters of 32 bits share a long, so 32 sums take the votes on 64 bits.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import LAST_ID, scratch
from tallyworks.operators.joins import join_hot

BITS = 64
SEPARATOR = r"[\x20\x09-\x0D]+"
NEIGHBOUR_BITS = 11
_PAIR = 0x0000000100000001


def word_array(text: Column) -> Column:
    """Words of a text, none for a null one."""
    return F.coalesce(F.array_remove(F.split(text, SEPARATOR), ""), F.array().cast("array<string>"))


def _votes(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Weight for each bit and in all, by ``keys``; a text without words has one row without weight."""
    words = texts.select(*keys, word_array(F.col(text)).alias("_w"))
    rest = F.when(F.size("_w") > 1, F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    terms = words.select(*keys, F.inline_outer(F.arrays_zip(F.col("_w").alias("a"), rest.alias("b"))).alias("a", "b"))
    weight = F.least(F.octet_length("a") + F.coalesce(F.octet_length("b"), F.lit(0)), F.lit(32)).cast("long")
    hashed = terms.select(*keys, F.xxhash64("a", "b").alias("_h"), F.when(F.col("a").isNull(), F.lit(0).cast("long")).otherwise(weight).alias("_k"))
    sums = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(_PAIR)) * F.col("_k")).alias(f"_s{i}") for i in range(32)]
    return hashed.groupBy(*keys).agg(F.sum("_k").alias("_all"), *sums)


def _bits_of(votes: DataFrame) -> Column:
    """The fingerprint as a long, from the sums of ``_votes``."""
    low = F.lit(0xFFFFFFFF)
    half = [(i, F.col(f"_s{i}").bitwiseAND(low)) for i in range(32)] + [(i + 32, F.shiftrightunsigned(f"_s{i}", 32)) for i in range(32)]
    parts = [F.when(count * 2 > F.col("_all"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")) for i, count in half]
    while len(parts) > 1:  # a balanced tree, so that the expression stays shallow
        parts = [a.bitwiseOR(b) for a, b in zip(parts[::2], parts[1::2], strict=True)]
    return parts[0]


def fingerprint(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (long) of each text; rows with equal keys vote together.

    Null texts and texts without words have fingerprint 0. Equal texts have equal fingerprints.
    """
    votes = _votes(texts, keys, text)
    return votes.select(*keys, _bits_of(votes).alias("fingerprint"))


def as_text(fingerprint: Column) -> Column:
    """16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that two fingerprints' distance stands for, from 0 (half the bits differ, or more) to 1."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * (3.141592653589793 / BITS)))


def block_masks(radius: int) -> list[tuple[int, int]]:
    """Number and mask of each block table.

    The bits are cut into ``radius + 2`` blocks, of which fingerprints within the radius share two at
    least, so there is a table for each two blocks, permuted to the front as its key.
    """
    n = radius + 2
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(n)]
    return list(enumerate(a | b for a, b in combinations(blocks, 2)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_fingerprints(prints: DataFrame, queries: DataFrame, radius: int, column: str = "fingerprint") -> DataFrame:
    """``query, found, distance``: all distinct values of ``prints`` within ``radius`` bits of each distinct query.

    Copies of a fingerprint take part once, so a group of copies adds one row; who has a value is a join
    away. Null values are left out. A pair is found in every table it agrees in and kept in the first.
    """
    if not 0 <= radius <= 20:
        raise ValueError("radius is from 0 to 20")
    masks = block_masks(radius)

    def posted(values: DataFrame, name: str) -> DataFrame:
        one = values.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()
        keys = [F.struct(F.lit(i).alias("table"), F.col(name).bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in masks]
        return one.select(name, F.explode(F.array(*keys)).alias("_t")).select(name, "_t.table", "_t.key")

    # a key that very many fingerprints share is split by AQE, as both sides come straight from an exchange
    pairs = posted(queries, "query").join(posted(prints, "found"), ["table", "key"])
    apart = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(i)) for i, m in masks])
    near = pairs.withColumn("distance", F.bit_count(apart)).filter(F.col("distance") <= radius)
    return near.filter(F.col("table") == first).select("query", "found", "distance")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_bucket, _row, doc_id, text, next_id, next_text``: the next document by descending id, after the last the first.

    Ids are cut into buckets of 2,048 neighbours, in each of which a window looks one row ahead; a
    bucket's last row takes the first row of the bucket below, from a table with one row a bucket. Rows
    with equal ids follow each other by text; a null id counts as the largest.
    """
    own = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.col(text).alias("text"))
    dealt = own.withColumn("_bucket", F.shiftright("doc_id", NEIGHBOUR_BITS))
    order = Window.partitionBy("_bucket").orderBy(F.col("doc_id").desc(), F.col("text"))
    rows = dealt.select(
        "*",
        F.row_number().over(order).alias("_row"),
        F.lead("doc_id").over(order).alias("_lead"),
        F.lead("text").over(order).alias("_lead_text"),
    )
    ends = dealt.groupBy("_bucket").agg(F.max("doc_id").alias("_head"))
    groups = ends.withColumn("_group", F.shiftright("_bucket", NEIGHBOUR_BITS))
    tops = groups.groupBy("_group").agg(F.max("_bucket").alias("_top"))
    whole = Window.orderBy(F.col("_group").desc())
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select("_group", F.lead("_top").over(whole).alias("_below"), F.max("_top").over(every).alias("_highest"))
    inner = Window.partitionBy("_group").orderBy(F.col("_bucket").desc())
    below = groups.withColumn("_in", F.lead("_bucket").over(inner)).join(tops, "_group")
    below = below.select(F.col("_bucket").alias("_from"), F.coalesce("_in", "_below", "_highest").alias("_bucket"))
    firsts = rows.filter("_row = 1").select("_bucket", F.col("doc_id").alias("_first"), F.col("text").alias("_first_text"))
    linked = below.join(firsts, "_bucket").select(F.col("_from").alias("_bucket"), "_first", "_first_text")
    joined = rows.join(linked, "_bucket")
    last = F.col("_lead").isNull()
    return joined.select(
        "_bucket",
        "_row",
        "doc_id",
        "text",
        F.when(last, F.col("_first")).otherwise(F.col("_lead")).alias("next_id"),
        F.when(last, F.col("_first_text")).otherwise(F.col("_lead_text")).alias("next_text"),
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its later half replaced by as much of ``following``, in code points."""
    whole, other = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    half = F.floor(F.char_length(whole) / 2).cast("int")
    return F.concat(F.substring(whole, F.lit(1), F.char_length(whole) - half), F.substring(other, F.lit(1), half))


def near_counts(prints: DataFrame, radius: int, every: int, doc_id: str = "doc_id", column: str = "fingerprint") -> DataFrame:
    """``fingerprint, n_near``: how many rows have a fingerprint within ``radius`` bits, for those of the ids divisible by ``every``.

    All rows are searched; equal fingerprints are counted, never paired. A row finds itself.
    """
    queries = prints.filter(F.col(doc_id) % every == 0).select(column)
    found = near_fingerprints(prints, queries, radius, column)
    sizes = prints.groupBy(F.col(column).alias("found")).agg(F.count("*").alias("_rows"))
    return found.join(sizes, "found").groupBy(F.col("query").alias(column)).agg(F.sum("_rows").alias("n_near"))


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int | None = None, every: int = 50) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each row.

    With a ``radius`` also ``n_near``: for ids divisible by ``every`` the number of rows, its own included, whose
    fingerprint differs in that many bits at most; null for other ids.

    ``edited`` says what the edit is. Null texts count as empty; a null id comes back null. With a
    single document the next one is itself. An empty table gives an empty table; other columns are left
    out, repeated rows stay.
    """
    rows = with_next(docs, doc_id, text).withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    facts = rows.select(
        "_bucket",
        "_row",
        "doc_id",
        "next_id",
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
    )
    both = rows.select("_bucket", "_row", F.inline(F.array(F.struct(F.lit(0).alias("_kind"), F.col("text").alias("_text")), F.struct(F.lit(1).alias("_kind"), F.col("_edited").alias("_text")))))
    prints = fingerprint(both, ["_bucket", "_row", "_kind"], "_text")
    wide = prints.groupBy("_bucket", "_row").agg(
        F.max(F.when(F.col("_kind") == 0, F.col("fingerprint"))).alias("_own"),
        F.max(F.when(F.col("_kind") == 1, F.col("fingerprint"))).alias("_changed"),
    )
    known = scratch(facts.join(wide, ["_bucket", "_row"]))
    following = known.groupBy(F.col("doc_id").alias("next_id")).agg(F.min_by("_own", "_row").alias("_next"))
    out = known.join(following, "next_id")
    if radius is not None:
        rows = known.select(F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), F.col("_own").alias("fingerprint"))
        counts = near_counts(rows, radius, every).withColumnRenamed("fingerprint", "_query")
        asks = F.when((F.col("doc_id") != LAST_ID) & (F.col("doc_id") % every == 0), F.col("_own"))
        out = join_hot(out.withColumn("_query", asks), counts, "_query", "left")
    extra = ["n_near"] if radius is not None else []
    return out.select(
        F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
        *extra,
    )
