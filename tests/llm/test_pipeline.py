"""Queries against their SQL, and the pipeline's stages one after the other."""

from collections import Counter, defaultdict

import duckdb
import pytest
import public_tokenizers
from test_near_dedup import brute as near_brute
from test_substring_dedup import brute as substring_brute
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tallyworks.llm.queries import QUERIES, SQL
from tallyworks.llm.shared import scratch

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    cursor = connection.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(cursor.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = scratch(stage(spark, docs, MIDDLE))
        after = docs.collect()
        kept[name] = (before, after)
        if name != "packing":
            assert docs.columns == columns
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    before, after = kept["quality"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert sum(labels[i].quality == 0 for i in gone if i in labels) >= 0.8 * sum(labels[r.doc_id].quality == 0 for r in before if r.doc_id in labels)
    assert sum(labels[i].quality for i in gone if i in labels) <= 0.05 * sum(x.quality for x in labels.values())
    before, after = kept["near_dedup"]
    wanted = {r[0] for r in near_brute([tuple(r) for r in before], 5, 80) if r[3]}
    assert {r.doc_id for r in after} == wanted
    before, after = kept["substring_dedup"]
    got = Counter((r.doc_id, " ".join(r.text.split(" ")) if r.text else "") for r in after)
    cut = {(r[0], r[3]) for r in substring_brute([tuple(r) for r in before], 13) if r[2]}
    assert cut <= set(got)
    assert all(r.n_chars == len(r.text or "") for r in after)
    same = {r.doc_id: r.text for r in before}
    assert all(r.text == same[r.doc_id] for r in after if (r.doc_id, r.text) not in cut)
    before, after = kept["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r.length for r in after) == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before)
    sequences = defaultdict(int)
    for r in after:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048 and len(sequences) <= -(-sum(sequences.values()) // 2048) + 2


def test_run_is_the_stages_in_turn(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0
