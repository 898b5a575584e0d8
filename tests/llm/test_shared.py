import glob
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import words
from tallyworks.llm.near_dedup import drop_near_duplicates, near_duplicates
from tallyworks.llm.packing import pack
from tallyworks.llm.shared import BATCH_BYTES, components, running_total, scratch_folder, ship
from tallyworks.llm.token_ids import _Table


@pytest.fixture
def many_partitions(spark):
    """As where a cluster's settings leave every shuffle in many partitions, however few its rows."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _files(spark):
    return set(glob.glob(f"{scratch_folder(spark).removeprefix('file:')}/corpus/*/part-*"))


def test_components_of_few_links_are_few_files(many_partitions):
    rng, n = random.Random(4), 400
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(300)] + [(n + i, n + i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)]
    least = list(range(1100))
    for _ in range(1100):
        new = list(least)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b])
        if new == least:
            break
        least = new
    wanted = {x: least[x] for a, b in edges if a != b for x in (a, b)}
    before = _files(many_partitions)
    df = many_partitions.createDataFrame(edges, "a long, b long").repartition(40, "a")
    got = components(df, most=len(edges))
    assert sorted(tuple(r) for r in got.collect()) == sorted(wanted.items())
    made = [os.path.dirname(f) for f in _files(many_partitions) - before]
    assert made and max(made.count(d) for d in made) == 1


def test_links_that_are_stars_take_no_turn(many_partitions):
    before = _files(many_partitions)
    got = components(many_partitions.createDataFrame([(2, 1), (1, 3), (5, 4)], "a long, b long"), most=3)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert len(_files(many_partitions) - before) == 1
    assert components(many_partitions.createDataFrame([], "a long, b long"), most=0).count() == 0


def test_few_documents_are_few_files(many_partitions):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(30)) for _ in range(40)) for _ in range(60)]
    docs = many_partitions.createDataFrame([(i, texts[i % 60]) for i in range(200)], "doc_id long, text string")
    before = _files(many_partitions)
    kept = drop_near_duplicates(docs.repartition(1))
    assert kept.rdd.getNumPartitions() == near_duplicates(docs.repartition(1)).rdd.getNumPartitions() == 1
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    made = [os.path.dirname(f) for f in _files(many_partitions) - before]
    assert made and max(made.count(d) for d in made) == 1
    pieces = many_partitions.range(300).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 900 + 1).alias("length"))
    placed = pack(pieces)
    assert placed.rdd.getNumPartitions() == 1 and placed.count() == 300


def test_tables_of_powers_stay_small_and_give_the_same_hashes():
    text = b"one two " * 20_000 + b"x" * (3 * words.SEGMENT_BYTES) + b" two one"
    found = words.words_of([text])
    assert sum(t.nbytes for t in words._powers.values()) < 4 << 20
    for at, word in ((0, b"one"), (1, b"two"), (39_999, b"two"), (40_000, b"x" * (3 * words.SEGMENT_BYTES)), (40_002, b"one")):
        total, power = 0, 1
        for b in word:
            total, power = (total + (b + 1) * power) & words._MASK, power * words._BASE & words._MASK
        whole = np.array([(total + len(word) * 0xD6E8FEB86659FD93) & words._MASK], dtype=np.uint64)
        assert found.hash[at] == words.mix(whole)[0]
    assert len(found.hash) == 40_003


def test_running_total_over_many_parts(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 3001).alias("o"), (F.col("id") % 5).alias("v"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    rows = [tuple(r) for r in df.collect()]
    wanted = set()
    for g in {r[0] for r in rows}:
        total = 0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            wanted.add((*r, total))
            total += r[2]
    got = [tuple(r) for r in running_total(df, ["g"], "o", "v", "t", fan=50).collect()]
    assert len(got) == 3000 and set(got) == wanted


def test_batches_of_texts_are_bounded_in_bytes(spark):
    ship(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    docs = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 1500 and max(got) <= BATCH_BYTES // 20_000 + 1


def test_table_of_words_grows_with_its_keys():
    table, rng = _Table(18), np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 64, 150_000, dtype=np.uint64))
    rng.shuffle(keys)
    assert len(table.keys) <= 1 << 14
    for at in range(0, len(keys), 7_000):
        part = keys[at : at + 7_000]
        assert (table.find(part) < 0).all()
        table.add(part, np.arange(at, at + len(part), dtype=np.int32))
        assert (table.find(keys[: at + len(part)]) == np.arange(at + len(part))).all()
    assert len(table.keys) == 1 << 18 and table.used == len(keys)
