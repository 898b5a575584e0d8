"""Words of UTF-8 texts as numpy arrays: the helper of the operators that work on word windows.

A word is a maximal run of bytes other than space and 0x09-0x0D, which for UTF-8 is the same as a
run of such characters. Texts are laid end to end with a space between, so that all texts of a
chunk are cut and hashed in a few array operations; a chunk is bounded in bytes, so is memory.
A null text has no words. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: The tables of powers, which a worker keeps, have 16 bytes for each byte of a segment.
SEGMENT_BYTES = 1 << 16

_BASE = 0x9E3779B97F4A7C55 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int) -> np.ndarray:
    """Powers of ``base`` modulo 2^64 for one segment; built on first use in each worker."""
    if name not in _powers:
        table = np.full(SEGMENT_BYTES + 1, base, dtype=np.uint64)
        table[0] = 1
        _powers[name] = np.multiply.accumulate(table)
    return _powers[name]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every output bit depends on every input bit."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


@dataclass
class Words:
    """Words of several texts: ``start`` and ``end`` are byte places in ``data``; ``owner`` is the text's number."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    owner: np.ndarray
    first: np.ndarray  # place of each text's first word, and the number of words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each place on, and whether they lie in one text."""
        n = len(self.hash)
        out = np.zeros(n, dtype=np.uint64)
        inside = np.zeros(n, dtype=bool)
        m = n - size + 1
        if m > 0:
            for j, c in enumerate(constants(size, seed)):
                out[:m] += self.hash[j : j + m] * c
            out = mix(out)
            inside[:m] = self.owner[:m] == self.owner[size - 1 :]
        return out, inside


def _cut(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of one segment, which begins and ends between words."""
    if lower:
        data = _LOWER[data]
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[0::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    up = _power_table("up", _BASE) if len(data) <= SEGMENT_BYTES else None
    if up is None:  # one word longer than a segment: hashed by itself
        return start, end, np.array([_long_hash(data[s:e]) for s, e in zip(start, end, strict=True)], dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashed = (sums[end] - sums[start]) * _power_table("down", _INVERSE)[start]
    return start, end, mix(hashed + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _long_hash(word: np.ndarray) -> int:
    total, scale = 0, 1
    for at in range(0, len(word), SEGMENT_BYTES):
        part = word[at : at + SEGMENT_BYTES].astype(np.uint64) + np.uint64(1)
        total += scale * int((part * _power_table("up", _BASE)[: len(part)]).sum(dtype=np.uint64))
        scale = scale * pow(_BASE, len(part), 1 << 64) & _MASK
    hashed = np.array([(total + len(word) * 0xD6E8FEB86659FD93) & _MASK], dtype=np.uint64)
    return int(mix(hashed)[0])


def words_of(texts: list[bytes | None], lower: bool = False) -> Words:
    """The words of ``texts`` in order; ``lower`` turns A-Z to lower case before hashing."""
    lengths = np.array([len(t or b"") for t in texts], dtype=np.int64)
    data = np.frombuffer(b" ".join(t or b"" for t in texts), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(data):
        stop = min(len(data), at + SEGMENT_BYTES)
        if stop < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:stop]])
            if len(spaces):
                stop = at + int(spaces[-1]) + 1
            else:
                later = np.flatnonzero(_SPACE[data[stop:]])
                stop = stop + int(later[0]) + 1 if len(later) else len(data)
        s, e, h = _cut(data[at:stop], lower)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(h)
        at = stop
    empty = np.zeros(0, dtype=np.int64)
    start = np.concatenate(starts) if starts else empty
    starts.clear()
    end = np.concatenate(ends) if ends else empty
    ends.clear()
    hashed = np.concatenate(hashes) if hashes else empty.astype(np.uint64)
    hashes.clear()
    first = np.searchsorted(start, begins[: len(texts)])
    first = np.concatenate([first, [len(start)]]).astype(np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(first))
    return Words(data, start, end, hashed, owner, first)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without making Python strings."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def chunks(batch: pa.RecordBatch | pa.Table, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch | pa.Table]:
    """Slices of a batch whose texts have ``most`` bytes together, or a single longer text."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 32
    at, n = 0, len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    while at < n:
        stop = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop
