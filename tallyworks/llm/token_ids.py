"""Token ids of whole texts with the tokenizers library, each distinct word encoded once per worker.

Byte-level BPE cuts a text into pre-tokens before it merges, and always between a character that is
no white space and a white-space character behind it. So the ids of a text are those of its words,
each with the space before it, and of the white-space runs between, which the library encodes on
their own with the same result. Words are looked up in a table by 64-bit hash; only words not seen
yet go to the library. Texts with white space beyond ASCII take the library's way whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyworks.llm.shared import kept, release
from tallyworks.llm.words import Words, chunks, mix, text_bytes, words_of

TABLE_BITS = 21
_SPACED = np.uint64(0xA24BAED4963EE407)
_RUN = 0x9FB21C651E98DF25
_JOINED = 400
#: What the byte level's pattern takes together: Latin letters (of one byte or two), digits, marks. Words of other bytes are not cut here.
_OTHER, _LETTER, _DIGIT, _MARK = range(4)
_KINDS = np.full(256, _OTHER, dtype=np.uint8)
_KINDS[0x21:0x7F] = _MARK
_KINDS[0x30:0x3A] = _DIGIT
for _first, _end in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0xC0), (0xC3, 0xCA)):
    _KINDS[_first:_end] = _LETTER
_KINDS[ord("'")] = _OTHER  # it may begin a pre-token together with letters
#: How the byte level spells the bytes of such words, a space, and bytes that no UTF-8 text has, which may stand between pre-tokens.
_LEVEL = np.arange(256, dtype="<u4")
_LEVEL[0x7F:0xA1] = 289 + np.arange(0xA1 - 0x7F)
_LEVEL[0xAD] = 323
_GAP = 0x120
_NEVER = [chr(c) for c in (0xC0, 0xC1, *range(0xF5, 0x100))]


def encoder(path: str) -> TokenEncoder:
    """This worker's encoder; it outlives a task, and so do the words it has seen, until the worker goes on to another step."""
    return kept(("ids", path), lambda: TokenEncoder(path))


class _Table:
    """Open addressing over uint64 keys, all queries of a call at once; it grows with its keys, up to ``most`` bits."""

    def __init__(self, most: int):
        self.most, self.used = most, 0
        self._empty(min(most, 14))

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int32)
        at = np.arange(len(keys))
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(at):
            value = self.values[slot]
            taken = value >= 0
            hit = taken & (self.keys[slot] == keys[at])
            out[at[hit]] = value[hit]
            on = taken & ~hit
            at, slot = at[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` are distinct and not in the table."""
        self.used += len(keys)
        if self.bits < self.most and self.used > 1 << (self.bits - 1):
            held = self.values >= 0
            keys, values = np.concatenate([self.keys[held], keys]), np.concatenate([self.values[held], values])
            self._empty(min(self.most, self.used.bit_length() + 1))
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.values[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]] = keys[won]
            self.values[slot[won]] = values[won]
            rest = np.ones(len(keys), dtype=bool)
            rest[won] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)


class _Pool:
    """A growing array."""

    def __init__(self, kind: type):
        self.data, self.size = np.zeros(1 << 16, dtype=kind), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            grown = np.zeros(max(need, 2 * len(self.data)), dtype=self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : need] = values
        self.size = need


def gather(pool: np.ndarray, offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``pool[offset[i] : offset[i] + length[i]]`` for all i, end to end."""
    total = int(length.sum())
    if not total:
        return pool[:0]
    ends = np.cumsum(length)
    index = np.ones(total, dtype=np.int64)
    full = np.flatnonzero(length)
    begins = (ends - length)[full]
    index[begins] = offset[full]
    index[begins[1:]] -= offset[full[:-1]] + length[full[:-1]] - 1
    return pool[np.cumsum(index)]


class TokenEncoder:
    def __init__(self, path: str, bits: int = TABLE_BITS):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        level, model, vocabulary = self.tokenizer.pre_tokenizer, self.tokenizer.model, self.tokenizer.get_vocab()
        sure = isinstance(level, ByteLevel) and level.use_regex and not level.add_prefix_space and self.tokenizer.normalizer is None
        sure &= isinstance(model, BPE) and not (model.dropout or model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix)
        #: What may stand between pre-tokens: it has an id, and no merge takes it.
        merged = set("".join(t for t in vocabulary if len(t) > 1))
        self.between = next((c for c in _NEVER if c in vocabulary and c not in merged), None)
        sure &= self.between is not None and all(c in vocabulary for c in ByteLevel.alphabet())
        #: The same model without cutting, for words that are cut here, and the kinds of their bytes; none where the tokenizer might cut or change them otherwise.
        self.model, self.kinds = Tokenizer(model), _KINDS.copy()
        marks = [[ord(c) for c in t.content if c.isascii() and _KINDS[ord(c)] == _MARK] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds[[m[0] for m in marks if m]] = _OTHER
        if not sure or not all(marks):
            self.kinds[:] = _OTHER
        self.newline = self._plain("\n")
        if len(self.newline) != 1:
            raise ValueError("the tokenizer has no id of its own for a line break")
        self.bits = bits
        self._clear()

    def _clear(self) -> None:
        self.table = _Table(self.bits)
        self.ids, self.offset, self.length = _Pool(np.uint32), _Pool(np.int64), _Pool(np.int32)
        for pool in (self.offset, self.length):
            pool.extend(np.zeros(1, dtype=pool.data.dtype))  # item 0 has no ids

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, keys: np.ndarray, ids: list[np.ndarray] | np.ndarray, lengths: np.ndarray) -> None:
        flat = ids if isinstance(ids, np.ndarray) else np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        number = self.length.size + np.arange(len(keys), dtype=np.int32)
        self.offset.extend(self.ids.size + np.cumsum(lengths) - lengths)
        self.length.extend(lengths)
        self.ids.extend(flat)
        self.table.add(keys, number)

    def _keys(self, words: Words, spaced: np.ndarray, salts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        """The table key of each word, and its variant where a word has several."""
        return mix(words.hash + np.where(spaced, _SPACED, np.uint64(0))), None

    def _learn_words(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> None:
        """Words at ``start`` to ``end`` of ``data``: those cut here, and others, between which a line break is a pre-token of its own."""
        plain = self._cut_here(data, start, end)
        at = np.flatnonzero(plain)
        if len(at):
            self._learn(keys[at], *self._lettered(data, start[at], end[at], spaced[at]))
        for flag in (True, False):
            at = np.flatnonzero(~plain & (spaced == flag))
            for few in (at[k : k + _JOINED] for k in range(0, len(at), _JOINED)):
                joined = b"\n".join(data[start[i] : end[i]].tobytes() for i in few)
                self._learn(keys[few], *self._broken(joined.decode("utf-8", "replace").split("\n"), flag))

    def _cut_here(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which words have only bytes whose kind tells the pre-tokens: two-byte letters are U+00C0 to U+024F but for two signs."""
        size = end - start
        text, heads = gather(data, start, size), np.cumsum(size) - size
        lead, before = (text >= 0xC3) & (text <= 0xC9), np.zeros(len(text), dtype=np.uint8)
        before[1:] = text[:-1]
        before[heads] = 0
        odd = self.kinds[text] == _OTHER
        odd |= ((text >= 0x80) & (text < 0xC0)) != ((before >= 0xC3) & (before <= 0xC9))
        odd |= ((before == 0xC9) & (text > 0x8F)) | ((before == 0xC3) & ((text == 0x97) | (text == 0xB7)))
        odd[heads + size - 1] |= lead[heads + size - 1]
        return ~np.logical_or.reduceat(odd, heads)

    def _lettered(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are cut here, and how many each has. A separator that the model never merges stands before each pre-token."""
        size = end - start
        text, heads = gather(data, start, size), np.cumsum(size) - size
        kind, cut = self.kinds[text], np.ones(len(text), dtype=bool)
        cut[1:] = kind[1:] != kind[:-1]
        cut[heads] = True
        wide = cut.astype(np.int64) + 1
        wide[heads] += spaced
        place = np.cumsum(wide) - 1
        spelt = np.full(int(wide.sum()), ord(self.between), dtype="<u4")
        spelt[place] = _LEVEL[text]
        spelt[place[heads[spaced]] - 1] = _GAP
        edges = np.append((place[heads] - 1 - spaced)[::_JOINED], len(spelt))
        parts = [spelt[a:b].tobytes().decode("utf-32-le") for a, b in zip(edges[:-1], edges[1:], strict=True)]
        made = [self.model.encode_batch_fast([part], add_special_tokens=False)[0].ids for part in parts]
        ids = np.concatenate([np.array(one, dtype=np.uint32) for one in made])
        between = ids == self.model.token_to_id(self.between)
        pieces = np.add.reduceat(cut.astype(np.int64), heads)
        begins = np.flatnonzero(between)[np.cumsum(pieces) - pieces]
        return ids[~between], (np.diff(begins, append=len(ids)) - pieces).astype(np.int32)

    def _broken(self, words: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        gap = "\n " if spaced else "\n"
        ids = np.array(self._plain(gap[1:] + gap.join(words)), dtype=np.uint32)
        breaks = np.flatnonzero(ids == self.newline[0])
        return np.delete(ids, breaks), (np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1).astype(np.int32)

    def _run_key(self, run: bytes, spaced: bool, tail: bool) -> int:
        """The key of a white-space run before a word or at a text's end; its ids are learned on first sight."""
        digest = hashlib.blake2b(run, digest_size=8, key=bytes([spaced, tail])).digest()
        key = np.array([int.from_bytes(digest, "little") ^ _RUN], dtype=np.uint64)
        if self.table.find(key)[0] < 0:
            ids = self._run_ids(run, spaced, tail)
            self._learn(key, ids, np.array([len(ids)], dtype=np.int32))
        return int(key[0])

    def _run_ids(self, run: bytes, spaced: bool, tail: bool) -> np.ndarray:
        """Ids of a white-space run: one pre-token at the end or before a space, else its last character is one more."""
        parts = [run] if tail or spaced else [run[:-1], run[-1:]]
        return np.array([i for p in parts if p for i in self._plain(p.decode())], dtype=np.uint32)

    def encode(self, texts: list[bytes | None], salts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins and the last ends. Null counts as empty.

        ``salts`` vary the variants of words between texts, for encoders that have any.
        """
        if self.table.used > (1 << self.bits) * 0.6:
            self._clear()
        texts = [t or b"" for t in texts]
        words = words_of(texts)
        data, n = words.data, len(words.start)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])[: len(texts)]
        before = np.zeros(n, dtype=np.int64)
        before[1:] = words.end[:-1]
        heads = words.first[:-1][words.counts > 0]
        before[heads] = begins[words.owner[heads]]
        gap = words.start - before
        spaced = (gap > 0) & (data[np.maximum(words.start - 1, 0)] == 32) if n else np.zeros(0, dtype=bool)
        keys, _ = self._keys(words, spaced, salts)
        found = self.table.find(keys)
        odd = self._odd(texts, data, begins, sizes)
        if len(odd):  # their words are not words to the library, and would mislead those learned beside them
            found[np.isin(words.owner, odd)] = 0
        if (found < 0).any():
            unseen, where = np.unique(keys[found < 0], return_index=True)
            place = np.flatnonzero(found < 0)[where]
            self._learn_words(unseen, data, words.start[place], words.end[place], spaced[place])
            missing = np.flatnonzero(found < 0)
            found[missing] = self.table.find(keys[missing])
        extra = np.flatnonzero(gap - spaced > 0)
        runs = np.array(
            [self._run_key(data[before[i] : words.start[i] - spaced[i]].tobytes(), bool(spaced[i]), False) for i in extra]
            if len(extra) < 64
            else self._run_keys(data, before[extra], words.start[extra] - spaced[extra], spaced[extra]),
            dtype=np.uint64,
        )
        last = begins.copy()
        some = words.counts > 0
        last[some] = words.end[words.first[1:][some] - 1]
        tails = np.flatnonzero(begins + sizes > last)
        ends = np.array([self._run_key(data[last[t] : begins[t] + sizes[t]].tobytes(), False, True) for t in tails], dtype=np.uint64)
        items = found
        if len(extra) or len(tails):
            at = np.concatenate([words.first[1:][tails], extra])
            items = np.insert(found, at, self.table.find(np.concatenate([ends, runs])))
        per_text = words.counts + np.bincount(words.owner[extra], minlength=len(texts)) + np.bincount(tails, minlength=len(texts))
        lengths = self.length.data[items].astype(np.int64)
        ids = gather(self.ids.data, self.offset.data[items], lengths)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        offsets = upto[np.concatenate([[0], np.cumsum(per_text)])]
        if not len(odd):
            return ids, offsets
        parts = [ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
        for i, one in zip(odd, self._whole([texts[i] for i in odd], None if salts is None else salts[odd]), strict=True):
            parts[i] = np.array(one, dtype=np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _odd(self, texts: list[bytes], data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Texts that go the slow way."""
        return _other_space(data, begins, sizes)

    def _whole(self, texts: list[bytes], salts: np.ndarray | None) -> list[list[int]]:
        found = self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [one.ids for one in found]

    def _run_keys(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, spaced: np.ndarray) -> np.ndarray:
        """As ``_run_key`` for many runs, most of which are one byte."""
        out = np.zeros(len(start), dtype=np.uint64)
        single = (end - start == 1) & ~spaced
        byte = data[start]
        for value in np.unique(byte[single]):
            out[single & (byte == value)] = self._run_key(bytes([value]), False, False)
        for i in np.flatnonzero(~single):
            out[i] = self._run_key(data[start[i] : end[i]].tobytes(), bool(spaced[i]), False)
        return out


def _other_space(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Texts with a white-space character that UTF-8 writes in several bytes."""
    a, b = data[:-1], data[1:]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = (a == 0xE1) & (b == 0x9A) | (a == 0xE2) & ((b == 0x80) | (b == 0x81)) | (a == 0xE3) & (b == 0x80)
    at = np.flatnonzero(two | three)
    if not len(at):
        return at
    return np.unique(np.searchsorted(begins, at, side="right") - 1)


def encoded(batches: Iterator[pa.RecordBatch], path: str, text: str, end_id: int | None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the ids of their texts, each text's followed by ``end_id``."""
    own = encoder(path)
    for batch in batches:
        for part in chunks(batch, text):
            ids, offsets = own.encode(text_bytes(part.column(text)))
            if end_id is not None:
                ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                offsets = offsets + np.arange(len(offsets))
            yield part, ids, offsets
        release(keep=True)


def binary_column(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value for each span of ids, as little-endian unsigned 32-bit integers."""
    flat = np.ascontiguousarray(ids, dtype="<u4")
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(flat)]
    ).cast(pa.binary())


def filled_ids(column: pa.Array | pa.ChunkedArray, missing: int) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), missing).to_numpy(zero_copy_only=False)
