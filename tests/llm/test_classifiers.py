import numpy as np
import pytest
from messy import SCHEMA, empty, messy, messy_rows
from pyspark.sql import functions as F

from tallyworks.llm.learning import best_threshold, held_out, labelled_sample, platt
from tallyworks.llm.quality import byte_inputs, fit_quality, score_quality
from tallyworks.llm.quality import train as train_quality
from tallyworks.llm.toxicity import buckets, fit_toxicity, score_toxicity
from tallyworks.llm.toxicity import train as train_toxicity

DATA = "/root/testdata/sf0.01"


def held_out_accuracy(spark, scored, score, label, held):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = scored.select("doc_id", score).join(labels, "doc_id").filter(held).select((F.col(score) >= 0.3).cast("int").alias("p"), F.col(label).alias("y")).collect()
    return np.mean([r.p == r.y for r in rows]), len(rows)


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels.filter(~held_out("doc_id", 5, 0)))
    right, n = held_out_accuracy(spark, score_quality(docs, model), "quality_score", "quality", held_out("doc_id", 5, 0))
    assert n > 50 and right > 0.95


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels.filter(~held_out("doc_id", 4, 2)))
    right, n = held_out_accuracy(spark, score_toxicity(docs, model), "toxicity", "toxic", held_out("doc_id", 4, 2))
    assert n > 50 and right > 0.9


def synthetic(rng, n):
    bad = ["grumbo", "fleet", "zork"]
    texts, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(0, 300)}" for _ in range(rng.integers(5, 80))]
        label = int(i % 4 == 0)
        if label:
            words[rng.integers(0, len(words))] = bad[rng.integers(0, 3)]
        texts.append(" ".join(words).encode())
        labels.append(label)
    return texts, np.array(labels)


def test_toxicity_finds_single_words_anywhere_in_long_texts():
    rng = np.random.default_rng(0)
    texts, labels = synthetic(rng, 600)
    rows, counts = buckets(texts)
    model = train_toxicity(np.split(rows, np.cumsum(counts)[:-1]), labels, ["en"] * 600)
    clean = " ".join(f"w{i % 300}" for i in range(20_000)).encode()
    asked = [clean, clean + b" Zork!", b"", b"zork", None]
    scores = model.scores(*buckets(asked))
    assert scores[1] > 0.5 > scores[0] and scores[3] > 0.5 and scores[2] == scores[4] < 0.5
    one_by_one = [model.scores(*buckets([t]))[0] for t in asked]
    assert scores == pytest.approx(one_by_one, abs=1e-6)


def test_quality_sees_the_whole_text_and_each_text_alone():
    rng = np.random.default_rng(1)
    good = [" ".join(f"w{rng.integers(0, 300)}" for _ in range(rng.integers(5, 200))).encode() for _ in range(120)]
    bad = [" ".join(f"w{rng.integers(0, 300)}&&&" for _ in range(rng.integers(5, 200))).encode() for _ in range(60)]
    texts = [t for pair in zip(good[:60], bad, good[60:], strict=True) for t in pair]
    model = train_quality(texts, np.array([1, 0, 1] * 60), epochs=4)
    asked = [good[0], bad[0], b"", None, b"x", b" ".join(good), b" ".join(bad)]
    scores = model.scores(asked)
    assert scores[0] > 0.5 > scores[1] and scores[5] > 0.5 > scores[6] and scores[2] == scores[3]
    assert scores == pytest.approx([model.scores([t])[0] for t in asked], abs=1e-5)


def test_repeats_are_marked_within_a_text_only():
    inputs, begins = byte_inputs([b"abcdefgh", b"abcdefgh", b"tick tock tick tock "])
    assert begins.tolist() == [0, 14, 28, 54]
    assert (inputs[:28] < 256).all()
    assert (inputs[28 + 10 : 28 + 16] >= 256).all()


def test_scores_for_messy_rows(spark):
    labels = spark.createDataFrame([(r[0], i % 2, (i // 2) % 2) for i, r in enumerate(messy_rows()) if r[0] is not None] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = messy(spark)
    q = score_quality(docs, fit_quality(docs, labels))
    t = score_toxicity(docs, fit_toxicity(docs, labels))
    assert q.count() == t.count() == len(messy_rows())
    assert q.columns == [*docs.columns, "quality_score"]
    assert t.columns == [*[c for c in docs.columns if c != "toxic"], "toxicity", "toxic"]
    assert q.filter("quality_score is null or quality_score < 0 or quality_score > 1").count() == 0
    assert t.filter("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    copies = t.filter("n_chars > 0").groupBy("text").agg(F.max("toxicity") - F.min("toxicity")).toDF("text", "d")
    assert copies.filter("d > 1e-6").count() == 0


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = messy(spark)
    assert score_quality(docs, fit_quality(docs, none)).count() == len(messy_rows())
    assert score_toxicity(docs, fit_toxicity(docs, none)).count() == len(messy_rows())
    assert score_toxicity(empty(spark), fit_toxicity(empty(spark), none)).count() == 0
    assert score_quality(empty(spark), fit_quality(empty(spark), none)).schema[0].name == SCHEMA.split()[0]


def test_sample_is_bounded_and_stable(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    one = {r.sample_id for r in labelled_sample(labels, "quality", 50).collect()}
    two = {r.sample_id for r in labelled_sample(labels.repartition(7), "quality", 50).collect()}
    assert len(one) == 50 and one == two


def test_calibration():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * x - 1)))).astype(int)
    slope, offset = platt(x, y)
    assert slope == pytest.approx(0.5, abs=0.1) and offset == pytest.approx(-1, abs=0.15)
    assert platt(x, np.zeros(4000, int)) == (1.0, 0.0)
    a, b = platt(np.array([-1e4, 1e4]), np.array([0, 1]))
    assert 0.1 <= a <= 4 and -10 <= b <= 10
    assert best_threshold(np.array([0.9, 0.8, 0.7, 0.1, 0.2]), np.array([1, 1, 1, 0, 0]), 0.5) == pytest.approx(0.45)
    assert best_threshold(np.array([0.9]), np.array([0]), 0.5) == 0.5
