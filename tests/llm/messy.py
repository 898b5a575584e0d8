"""Small tables with what real ones have: nulls, empty and very long texts, ties, copies, clashing names."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, label string, _row int, toxic string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def messy_rows(seed: int = 1, n: int = 60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "日本", "a b", "É", "#$", "don't"]

    def text(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    passage, base = text(60), text(120)
    texts = [None, "", " \n\t ", "one", "Two words", "two  WORDS", text(9000), passage, passage + " " + text(30), text(20) + "\n" + passage]
    texts += [base, base, base.upper().lower(), base + " tail", base.replace("w1", "w2", 1), base + "\n"]
    texts += [text(rng.randrange(1, 200)) for _ in range(n - len(texts))]
    texts += ["same line\nsame line\nsame line\nother " * 8, "spam spam spam spam spam spam spam spam spam spam " * 5]
    rows = [(i * 3, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(t or ""), "x", "y", 1, "z") for i, t in enumerate(texts)]
    rows.append(rows[12])  # a repeated row
    rows.append((None, base + " tail", "en", "a", 1, None, None, None, None))
    rng.shuffle(rows)
    return rows


def messy(spark, **options):
    return spark.createDataFrame(messy_rows(**options), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
