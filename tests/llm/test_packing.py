import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from messy import empty, messy, messy_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm.packing import document_pieces, pack, pack_documents, packed_sequences, plan_packing
from tallyworks.llm.shared import scratch
from tallyworks.llm.token_ids import TokenEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def lay_out(counts, limit):
    plan = plan_packing(counts, limit)
    length, first, each, sequence, offset = plan.arrays()
    sequences = defaultdict(list)
    for size, n in counts.items():
        for rank in range(n):
            i = np.searchsorted(length * (1 << 40) + first, size * (1 << 40) + rank, side="right") - 1
            assert length[i] == size
            k = int(rank - first[i])
            sequences[int(sequence[i]) + k // int(each[i])].append((int(offset[i]) + k % int(each[i]) * size, size))
    for parts in sequences.values():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at <= limit
    assert sorted(sequences) == list(range(plan.sequences))
    return plan.sequences


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_close_to_the_bound(seed):
    rng = random.Random(seed)
    counts = Counter(min(64, max(1, int(rng.lognormvariate(2.3, 1)))) for _ in range(3000))
    used = lay_out(counts, 64)
    assert used <= -(-sum(k * n for k, n in counts.items()) // 64) * 1.01 + 1


def test_plan_uses_exact_complements():
    assert lay_out({40: 5, 24: 5}, 64) == 5  # singles
    assert lay_out({30: 4, 20: 4, 14: 4}, 64) == 4  # pairs
    assert lay_out({30: 3, 15: 3, 10: 3, 9: 3}, 64) == 3  # triples
    assert lay_out({}, 64) == 0
    assert lay_out({64: 3, 1: 65}, 64) == 5
    assert lay_out({16: 4}, 64) == 1
    assert lay_out({33: 7}, 64) == 7


def test_encoder_equals_library():
    own, library = TokenEncoder(PATH, bits=12), Tokenizer.from_file(PATH)
    texts = [r[1] for r in messy_rows()] + ["a\n\nb", "  x y  ", "x\x1cy", "tab\t\tend \n", "　", "don't 'll 12 345"]
    for _ in range(2):  # the second time from the table
        ids, offsets = own.encode([None if t is None else t.encode() for t in texts])
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_pack_documents(spark):
    docs = messy(spark)
    rows = pack_documents(docs, PATH, limit=512).collect()
    library = Tokenizer.from_file(PATH)
    wanted = Counter()
    for r in messy_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [0]
        head = len(ids) % 512 if len(ids) > 512 else len(ids)
        cuts = [0, *range(head, len(ids) + 1, 512)] if head else list(range(0, len(ids) + 1, 512))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at <= 512
    assert len(sequences) <= -(-sum(r.length for r in rows) // 512) + 1


def test_many_rank_parts_give_each_place_once(spark):
    pieces = scratch(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20 + 1)).cast("long").alias("length")))
    rows = pack(pieces, limit=40, rank_rows=50).collect()
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == len(rows) == 2000


def test_packed_sequences_hold_the_ids_in_order(spark):
    placed = pack_documents(messy(spark), PATH, limit=256)
    whole = {r.sequence_id: r for r in packed_sequences(placed).collect()}
    for r in placed.collect():
        one = whole[r.sequence_id]
        assert bytes(one.ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
        assert one.n_tokens * 4 == len(one.ids) <= 1024


def test_empty_table_and_bad_lengths(spark):
    assert pack_documents(empty(spark), PATH).count() == 0
    assert document_pieces(empty(spark), PATH).columns == ["doc_id", "piece", "start", "length", "ids"]
    with pytest.raises(ValueError, match="more than 4"):
        pack(spark.createDataFrame([(1, 0, 5)], "doc_id long, piece int, length long"), limit=4)


def test_words_of_letters_are_cut_here_with_the_ids_of_the_library(monkeypatch):
    own, library = TokenEncoder(PATH, bits=12), Tokenizer.from_file(PATH)
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha() and c not in (0xAA, 0xB5, 0xBA)]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) + "".join(rng.choices(".,;:!?", k=rng.randint(0, 3))) for _ in range(900)]
    text = " ".join(words[:600]) + "\n" + "\n".join(words[600:])
    own.encode([b"\n \n"])
    monkeypatch.setattr(own, "_broken", lambda *a: pytest.fail("not cut here"))
    ids, _ = own.encode([text.encode()])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    monkeypatch.undo()
    odd = text + " don't it's x1 1x ( a.b .a a., 'Ǆ ª × a× � 中文. é <|endoftext|> a<|endoftext|>."
    ids, _ = own.encode([odd.encode()])
    assert ids.tolist() == library.encode(odd, add_special_tokens=False).ids


def test_words_of_letters_digits_and_marks_are_cut_here(monkeypatch):
    own, library = TokenEncoder(PATH, bits=12), Tokenizer.from_file(PATH)
    rng = random.Random(7)
    signs = [chr(c) for c in range(0x21, 0x7F) if chr(c) not in "'<"] + list("éßñŁ")
    words = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(1500)] + ["aaux###", "été.***", "16.183.68.211", "555-8981", "x" * 5000]
    text = " ".join(words[:900]) + "\n" + "\n".join(words[900:])
    own.encode([b"\n \n"])
    monkeypatch.setattr(own, "_broken", lambda *a: pytest.fail("not cut here"))
    ids, _ = own.encode([text.encode()])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_texts_with_other_white_space_do_not_mislead_the_words_of_others():
    own, library = TokenEncoder(PATH, bits=12), Tokenizer.from_file(PATH)
    rng = random.Random(2)
    texts = ["it's\n\u00a0\nso", *("\n".join("".join(rng.choices("ab'\u4e2d", k=5)) for _ in range(40)) for _ in range(5))]
    for _ in range(2):  # the second time from the table
        ids, offsets = own.encode([t.encode() for t in texts])
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
