import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from messy import empty, messy, messy_rows

from tallyworks.llm.merge_dropout import LONG, MergeEncoder, _candidates, encode_and_decode, encode_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", " ", "a", " a", "a  b", "a\nb\n", "a b", "ﬁ Ａ", "\t x ", "naïve café", "日本語 emoji 😀", "  12  3", "x   ", "\n\n a \n  b", "x" * 300]


def encode(encoder, texts, salts=None):
    ids, offsets = encoder.encode([b" " + t.encode() if t else b"" for t in texts], salts)
    return [ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def plainly(own, text, salt):
    """Brute force: unit by unit, all candidates listed anew after each merge."""
    out = []
    text = " " + text if text else ""
    for found in re.finditer(r"[ ]*[^ \t-\r▁]+|[ ]+|[\t-\r▁]", text):
        unit = found[0]
        if unit in "\t\n\v\f\r▁":
            out += [int(own.pieces.byte_ids[b]) for b in unit.encode()]
            continue
        base = own.base(np.array([salt], np.uint64), np.array([len(text[: found.start()].encode())]))
        symbols = [(i, own.pieces.number.get(c, -1), c) for i, c in enumerate(unit.replace(" ", "▁"))]
        gone = set()
        while True:
            offers = [
                (int(own.pieces.rank[whole]), i, whole)
                for i, (left, right) in enumerate(zip(symbols, symbols[1:], strict=False))
                if (whole := own.pieces.pairs.get((left[1], right[1]))) is not None and (left[0], left[1], right[1]) not in gone
            ]
            if not offers:
                break
            _, i, whole = min(offers)
            place, a, b = symbols[i][0], symbols[i][1], symbols[i + 1][1]
            if own.skips(base, _candidates(np.array([place]), np.array([a]), np.array([b])))[0]:
                gone.add((place, a, b))
            else:
                symbols[i : i + 2] = [(place, whole, "")]
        out += [x for _, n, c in symbols for x in ([n] if n >= 0 else [int(own.pieces.byte_ids[v]) for v in c.encode()])]
    return out


def test_without_dropout_it_is_the_library(library):
    texts = HARD + [r[1] or "" for r in messy_rows()]
    for text, ids in zip(texts, encode(MergeEncoder(PATH, 0.0, 0, bits=12), texts), strict=True):
        assert ids.tolist() == library.encode(text), text


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_trees_arrays_and_heap_do_what_the_plain_agenda_does(library, dropout):
    long = ["".join(f"abcdefgh{i}xyz"[i % 7 :] for i in range(n)) for n in (4, 6, 30)]
    texts = HARD + ["▁x ▁▁ y▁", "a  ▁ b▁ ", " " * 200 + "x", "日本語" * 40] + long + [(r[1] or "")[:400] for r in messy_rows()]
    assert {len(x) > LONG for x in long} == {True, False}
    salts = np.arange(len(texts), dtype=np.uint64)
    for bits in (10, 16):
        own = MergeEncoder(PATH, dropout, 7, bits)
        for turn in range(2):  # the second time from the trees
            for text, ids, salt in zip(texts, encode(own, texts, salts), salts, strict=True):
                if bits == 16 or not turn:
                    assert ids.tolist() == plainly(own, text, int(salt)), text
                assert own.pieces.decode(ids.astype(np.int64)).decode() == text
                if "▁" not in text:
                    assert library.decode(ids.tolist()) == text


def test_each_occurrence_draws_for_itself():
    """A unit of one merge is cut in a tenth of its occurrences, in one text and over documents."""
    own, n = MergeEncoder(PATH, 0.1, 3), 20_000
    assert own.pieces.number.get("▁a") is not None
    one, _ = own.encode([b" a" * n])
    other, _ = own.encode([b" a"] * n, np.arange(n, dtype=np.uint64))
    for ids in (one, other):
        assert abs((len(ids) - n) / n - 0.1) < 0.01
    assert one.tolist() == own.encode([b" a" * n])[0].tolist() != other.tolist()
    _, offsets = own.encode([b" a"] * n, np.arange(n, dtype=np.uint64))
    cut = np.diff(offsets) == 2
    assert abs((cut[:-1] & cut[1:]).mean() - 0.01) < 0.004  # neighbours are independent


def test_cuts_vary_with_seed_and_dropout_grows():
    text = "international understanding " * 200
    lengths = [len(encode(MergeEncoder(PATH, dropout, 3), [text])[0]) for dropout in (0.0, 0.1, 0.4)]
    assert lengths == sorted(lengths) and lengths[0] < lengths[2]
    a, b = (encode(MergeEncoder(PATH, 0.3, seed), [text])[0].tolist() for seed in (1, 2))
    assert a == encode(MergeEncoder(PATH, 0.3, 1), [text])[0].tolist() != b


@pytest.mark.parametrize("kind", ["no spaces", "double spaces", "one letter", "no pieces"])
def test_a_megabyte_of_odd_text_takes_seconds(kind):
    rng = np.random.default_rng(1)
    letters = "".join(chr(97 + i) for i in rng.integers(0, 26, 1 << 20))
    text = {
        "no spaces": letters,
        "double spaces": "  ".join(letters[i : i + 6] for i in range(0, 800_000, 6)),
        "one letter": "x" * (1 << 20),
        "no pieces": "㐀" * 350_000,
    }[kind]
    own = MergeEncoder(PATH, 0.1, 1)
    began = time.monotonic()
    ids = encode(own, [text])[0]
    assert time.monotonic() - began < 60
    assert own.pieces.decode(ids.astype(np.int64)).decode() == text


def test_every_text_decodes_to_itself(spark):
    out = encode_and_decode(messy(spark), PATH, seed=5)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r[0], r[1] or "") for r in messy_rows())
    assert all(r.n_pieces * 4 == len(r.ids) for r in out.collect())


def test_empty_table_and_bad_rates(spark):
    assert encode_pieces(empty(spark), PATH).count() == 0
    with pytest.raises(ValueError, match="dropout"):
        MergeEncoder(PATH, 1.5, 0)
