import public_tokenizers
import pyarrow as pa

from tallyworks.llm import shared
from tallyworks.llm.learning import afresh
from tallyworks.llm.token_ids import encoded, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_worker_keeps_its_encoder_only_until_another_step():
    own = encoder(PATH)
    batch = pa.record_batch({"text": ["a word", None]})
    assert len(list(encoded(iter([batch]), PATH, "text", 0))) == 1 and encoder(PATH) is own
    assert list(afresh(lambda rows: rows)(iter([1, 2]))) == [1, 2]
    assert not shared._kept and encoder(PATH) is not own


def test_another_thing_takes_the_place_of_what_was_kept():
    first = shared.kept(("a",), list)
    assert shared.kept(("a",), list) is first
    shared.kept(("b",), dict)
    assert set(shared._kept) == {("b",)}
    shared.release(keep=True)
    assert set(shared._kept) == {("b",)}
    shared.release()
    assert not shared._kept
