"""SentencePiece encoding and decoding with seeded merge-dropout.

A unit is a word with the spaces before it. Its characters are merged pair by pair, always the pair
whose piece has the best score, the leftmost of equals; each candidate that comes up is skipped if a
hash of the seed, the document, the unit's byte place in the text, the candidate's place in the unit
and the two pieces falls below the dropout rate. So every occurrence of a word is cut by draws of its
own, while every run gives the same ids. A skipped candidate is gone; a merge beside it makes new ones.

What the agenda offers next hangs only on the unit and on what was merged and skipped before. A worker
keeps these states as a tree per unit: an occurrence walks down by its own draws to the ids at the end,
and only one that leaves the known part is merged, many at once as rows of arrays, and its way is kept.
The tree saves work and changes no result; when it is full it starts anew. Units of more than ``LONG``
bytes are cut where no piece reaches across and merged with a heap. Decoding puts the pieces' bytes end
to end and drops the one space that encoding puts before a text. A literal U+2581 is written as bytes,
so that it does not come back as a space: every text decodes to itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.shared import LAST_ID, release, ship, with_fields
from tallyworks.llm.token_ids import _Pool, _Table, binary_column, filled_ids, gather
from tallyworks.llm.words import chunks, constants, mix, text_bytes

DROPOUT = 0.1
#: Bytes up to which a unit's states are kept.
LONG = 64
TABLE_BITS = 21
_ROWS = 20_000
_NEVER = np.int32(2**31 - 1)
_SPACE = "▁"
_MASK = (1 << 64) - 1
_SEED, _UNIT, _PLACE, _LEFT, _RIGHT = (int(x) for x in constants(5, 9))
_POWERS = constants(LONG, 10)
_encoders: dict[tuple, MergeEncoder] = {}
_decoders: dict[str, Pieces] = {}


class Pieces:
    """The model's pieces: which two make which, in what order, and the bytes of each."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(size)]
        self.number = {n: i for i, (n, p) in enumerate(zip(names, plain, strict=True)) if p}
        self.rank = np.array([min(2**31 - 2, int(round(-model.get_score(i)))) for i in range(size)], dtype=np.int32)
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.uint32)
        pairs = {}
        for name, whole in self.number.items():
            for cut in range(1, len(name)):
                a, b = self.number.get(name[:cut]), self.number.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = whole
        self.pairs, self.ranks = pairs, self.rank.tolist()
        beside = {(ord(x) << 32) | ord(y) for name in self.number for x, y in zip(name, name[1:], strict=False)}
        self.inner = np.array(sorted(beside), dtype=np.uint64)
        self.table = _Table(max(4, (4 * len(pairs)).bit_length()))
        keys = np.array([(a << 32) | b for a, b in pairs], dtype=np.uint64)
        self.table.add(mix(keys), np.array(list(pairs.values()), dtype=np.int32))
        value = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        spelt = [value.get(i) or (n.replace(_SPACE, " ").encode() if plain[i] else b"") for i, n in enumerate(names)]
        self.bytes = np.frombuffer(b"".join(spelt), dtype=np.uint8)
        self.sizes = np.array([len(x) for x in spelt], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of each pair, -1 if there is none (or a part is no piece)."""
        keys = mix((a.astype(np.int64).astype(np.uint64) << np.uint64(32)) | b.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))
        out = self.table.find(keys)
        out[(a < 0) | (b < 0)] = -1
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        found = gather(self.bytes, self.starts[ids], self.sizes[ids]).tobytes()
        return found[1:]


class MergeEncoder:
    def __init__(self, path: str, dropout: float, seed: int, bits: int = TABLE_BITS):
        if not 0 <= dropout <= 1:
            raise ValueError("dropout lies between 0 and 1")
        self.pieces = Pieces(path)
        self.bits, self.seed = bits, np.uint64(seed * _SEED & _MASK)
        self.limit = int(dropout * 2.0**53)
        self._clear()

    def _clear(self) -> None:
        self.roots = _Table(self.bits)
        self.candidate, self.next, self.leaf = _Pool(np.uint64), _Pool(np.int32), _Pool(np.int32)
        self.ids, self.offset, self.length = _Pool(np.uint32), _Pool(np.int64), _Pool(np.int32)
        spelt = [bytes([c]) for c in range(9, 14)] + [_SPACE.encode()]
        flat = self.pieces.byte_ids[np.frombuffer(b"".join(spelt), dtype=np.uint8)]
        self._entries(flat, np.array([len(x) for x in spelt]))

    def _entries(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Keep some sequences of ids, which lie end to end; their numbers."""
        numbers = self.length.size + np.arange(len(lengths), dtype=np.int32)
        self.offset.extend(self.ids.size + np.cumsum(lengths) - lengths)
        self.length.extend(lengths)
        self.ids.extend(ids)
        return numbers

    def _nodes(self, n: int) -> np.ndarray:
        numbers = self.leaf.size + np.arange(n, dtype=np.int32)
        self.candidate.extend(np.zeros(n, dtype=np.uint64))
        self.next.extend(np.full(2 * n, -1, dtype=np.int32))
        self.leaf.extend(np.full(n, -1, dtype=np.int32))
        return numbers

    def base(self, salts: np.ndarray, places: np.ndarray) -> np.ndarray:
        """What an occurrence puts into every draw."""
        return mix(mix(salts + self.seed) + places.astype(np.uint64) * np.uint64(_UNIT))

    def skips(self, base: np.ndarray, candidate: np.ndarray) -> np.ndarray:
        return (mix(base + candidate) >> np.uint64(11)) < np.uint64(self.limit)

    def encode(self, texts: list[bytes | None], salts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins and the last ends. Null counts as empty.

        ``salts`` tell documents apart: equal texts with equal salts are cut alike.
        """
        texts = [t or b"" for t in texts]
        data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)]).astype(np.int64)
        start, end = _units(data, begins)
        owner = np.searchsorted(begins, start, side="right") - 1
        salts = np.zeros(len(texts), dtype=np.uint64) if salts is None else salts
        counts = np.zeros(len(texts), dtype=np.int64)
        parts = [np.zeros(0, dtype=np.uint32)]
        block = 1 << (self.bits - 3)
        for at in range(0, len(start), block):
            if self.roots.used > (1 << self.bits) // 2 or max(self.leaf.size, self.ids.size // 2) > 1 << self.bits:
                self._clear()
            own = slice(at, at + block)
            entries = self._found(data, start[own], end[own], self.base(salts[owner[own]], start[own] - begins[owner[own]]))
            lengths = self.length.data[entries].astype(np.int64)
            parts.append(gather(self.ids.data, self.offset.data[entries], lengths))
            counts += np.bincount(owner[own], weights=lengths, minlength=len(texts)).astype(np.int64)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def _found(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The number of each unit's ids."""
        out = np.full(len(start), -1, dtype=np.int32)
        byte = data[start]
        white = (byte >= 9) & (byte <= 13)
        out[white] = byte[white] - 9
        out[_marks(data, start)] = 5
        for i in np.flatnonzero((out < 0) & (end - start > LONG)):
            ids = np.array(self.one(_spelt(data[start[i] : end[i]].tobytes()), int(base[i])), dtype=np.uint32)
            out[i] = self._entries(ids, np.array([len(ids)]))[0]
        rows = np.flatnonzero(out < 0)
        keys = _hashes(data, start[rows], end[rows])
        first = True
        while len(rows):
            last, way = self._walk(self.roots.find(keys), base[rows])
            known = way < 0
            out[rows[known]] = self.leaf.data[last[known]]
            rows, keys, last, way = rows[~known], keys[~known], last[~known], way[~known]
            if not len(rows):
                break
            stops = np.where(last < 0, keys, mix(2 * last.astype(np.uint64) + way.astype(np.uint64)))
            chosen = np.unique(stops, return_index=True)[1] if first else np.arange(len(rows))
            first = False
            units = [_spelt(data[s:e].tobytes()) for s, e in zip(start[rows[chosen]], end[rows[chosen]], strict=True)]
            self._remember(keys[chosen], units, base[rows[chosen]])
        return out

    def _walk(self, node: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each occurrence comes to in its tree, and the way it would go on if that is not known, else -1."""
        node = node.astype(np.int64)
        way = np.where(node < 0, 0, -1).astype(np.int8)
        at = np.flatnonzero(node >= 0)
        while len(at):
            at = at[self.leaf.data[node[at]] < 0]
            here = node[at]
            skip = self.skips(base[at], self.candidate.data[here])
            then = self.next.data[2 * here + skip]
            on = then >= 0
            way[at[~on]] = skip[~on]
            at = at[on]
            node[at] = then[on]
        return node, way

    def _remember(self, keys: np.ndarray, units: list[str], base: np.ndarray) -> None:
        """Merge units by their own draws and keep the ways they took."""
        own, inverse = np.unique(keys, return_inverse=True)
        root = self.roots.find(own)
        new = root < 0
        root[new] = self._nodes(int(new.sum()))
        self.roots.add(own[new], root[new])
        node = root[inverse].astype(np.int64)
        sizes = np.array([len(u) for u in units])
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            longest = max(8, int(sizes[order[at]]) * 3 // 2)
            stop = min(at + max(1, _ROWS * 16 // longest), int(np.searchsorted(sizes[order], longest, side="right")))
            rows = order[at:stop]
            ids, lengths, steps = self._merge([units[i] for i in rows], base[rows])
            for some, candidate, skip in steps:
                here = node[rows[some]]
                self.candidate.data[here] = candidate
                slot = 2 * here + skip
                fresh = np.unique(slot[self.next.data[slot] < 0])
                made = self._nodes(len(fresh))
                self.next.data[fresh] = made
                node[rows[some]] = self.next.data[slot]
            ends, pick = np.unique(node[rows], return_index=True)
            pick = pick[self.leaf.data[ends] < 0]
            made = self._entries(gather(ids, (np.cumsum(lengths) - lengths)[pick], lengths[pick]), lengths[pick])
            self.leaf.data[node[rows[pick]]] = made
            at = stop

    def _merge(self, units: list[str], base: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        """Ids of all units end to end, the number of each, and all turns: rows, candidates, whether skipped.

        Rows are units, columns their characters.
        """
        sizes = np.array([len(u) for u in units])
        width = int(sizes.max())
        flat = "".join(units)
        codes = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32)
        known, inverse = np.unique(codes, return_inverse=True)
        numbers = np.array([self.pieces.number.get(chr(c), -1) for c in known], dtype=np.int32)
        column = np.arange(width)
        inside = column < sizes[:, None]
        symbol = np.full((len(units), width), -1, dtype=np.int32)
        symbol[inside] = numbers[inverse]
        letter = np.zeros((len(units), width), dtype=np.uint32)
        letter[inside] = codes
        behind = np.where(column + 1 < sizes[:, None], column + 1, -1).astype(np.int32)
        before = np.broadcast_to(column - 1, behind.shape).astype(np.int32)
        alive = inside.copy()
        rank = self.pieces.rank

        def offers(row: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            whole = self.pieces.merged(symbol[row, left], symbol[row, right])
            return np.where(whole >= 0, rank[whole], _NEVER)

        offer = np.full((len(units), width), _NEVER, dtype=np.int32)
        row, left = np.nonzero(behind >= 0)
        offer[row, left] = offers(row, left, left + 1)
        rows = np.arange(len(units))
        steps = []
        while len(rows):
            best = offer[rows].argmin(axis=1)
            going = offer[rows, best] != _NEVER
            rows, best = rows[going], best[going]
            if not len(rows):
                break
            right = behind[rows, best]
            a, b = symbol[rows, best], symbol[rows, right]
            candidate = _candidates(best, a, b)
            skip = self.skips(base[rows], candidate)
            steps.append((rows, candidate, skip))
            offer[rows[skip], best[skip]] = _NEVER
            r, j, k = rows[~skip], best[~skip], right[~skip]
            symbol[r, j] = self.pieces.merged(a[~skip], b[~skip])
            alive[r, k] = False
            offer[r, k] = _NEVER
            then = behind[r, k]
            behind[r, j] = then
            on = then >= 0
            before[r[on], then[on]] = j[on]
            offer[r, j] = _NEVER
            offer[r[on], j[on]] = offers(r[on], j[on], then[on])
            prior = before[r, j]
            has = prior >= 0
            offer[r[has], prior[has]] = offers(r[has], prior[has], j[has])
        chosen = symbol[alive]
        counts = alive.sum(axis=1)
        unknown = np.flatnonzero(chosen < 0)
        if not len(unknown):
            return chosen.astype(np.uint32), counts, steps
        raw = [chr(c).encode("utf-8", "replace") for c in letter[alive][unknown]]
        many = np.ones(len(chosen), dtype=np.int64)
        many[unknown] = [len(x) for x in raw]
        out = np.repeat(chosen, many).astype(np.int64)
        out[np.repeat(chosen < 0, many)] = self.pieces.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(units)), counts)
        return out.astype(np.uint32), np.bincount(owner, weights=many, minlength=len(units)).astype(np.int64), steps

    def one(self, unit: str, base: int) -> list[int]:
        """A long unit, part by part: between two letters that stand together in no piece nothing merges."""
        codes = np.frombuffer(unit.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        together = np.isin(codes[:-1] << np.uint64(32) | codes[1:], self.pieces.inner)
        cuts = [0, *(np.flatnonzero(~together) + 1).tolist(), len(unit)]
        return [i for a, b in zip(cuts, cuts[1:], strict=False) for i in self._agenda(unit[a:b], a, base)]

    def _agenda(self, part: str, at: int, base: int) -> list[int]:
        """The agenda as a heap; ``at`` is the part's place in its unit. A stale offer names pieces that are gone."""
        pieces, pairs, ranks = self.pieces, self.pieces.pairs, self.pieces.ranks
        symbol = [pieces.number.get(c, -1) for c in part]
        n = len(symbol)
        behind, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            whole = pairs.get((symbol[i], symbol[i + 1]))
            if whole is not None:
                heap.append((ranks[whole], i, symbol[i], symbol[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            k = behind[i]
            if symbol[i] != a or k >= n or symbol[k] != b:
                continue
            drawn = _mixed(base + (at + i) * _PLACE + a * _LEFT + b * _RIGHT)
            if drawn >> 11 < self.limit:
                continue
            symbol[i], symbol[k] = pairs[a, b], None
            then = behind[i] = behind[k]
            if then < n:
                before[then] = i
                whole = pairs.get((symbol[i], symbol[then]))
                if whole is not None:
                    heapq.heappush(heap, (ranks[whole], i, symbol[i], symbol[then]))
            prior = before[i]
            if prior >= 0:
                whole = pairs.get((symbol[prior], symbol[i]))
                if whole is not None:
                    heapq.heappush(heap, (ranks[whole], prior, symbol[prior], symbol[i]))
        out: list[int] = []
        for s, c in zip(symbol, part, strict=True):
            if s is None:
                continue
            if s >= 0:
                out.append(s)
            else:
                out += pieces.byte_ids[list(c.encode("utf-8", "replace"))].tolist()
        return out


def _candidates(place: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What a candidate puts into its draw."""
    return place.astype(np.uint64) * np.uint64(_PLACE) + a.astype(np.uint64) * np.uint64(_LEFT) + b.astype(np.uint64) * np.uint64(_RIGHT)


def _mixed(value: int) -> int:
    """``mix`` of one number, without an array."""
    value &= _MASK
    value = (value ^ value >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    value = (value ^ value >> 27) * 0x94D049BB133111EB & _MASK
    return value ^ value >> 31


def _marks(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a literal U+2581 begins at each place; behind the last text stands a line break."""
    last = len(data) - 1
    return (data[at] == 0xE2) & (data[np.minimum(at + 1, last)] == 0x96) & (data[np.minimum(at + 2, last)] == 0x81)


def _units(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of all units: words with the spaces before them, spaces without a word, other white
    space and literal U+2581 one by one. The line break behind each text is none."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    space = data == 32
    alone = (data >= 9) & (data <= 13)
    leads = np.flatnonzero(data == 0xE2)
    leads = leads[_marks(data, leads)]
    begin = alone.copy()
    begin[leads] = True
    for step in range(3):
        alone[leads + step] = True
    begin[0] = True
    begin[1:] |= space[1:] & ~space[:-1] | ~space[1:] & ~alone[1:] & alone[:-1]
    start = np.flatnonzero(begin)
    end = np.append(start[1:], len(data))
    real = np.ones(len(start), dtype=bool)
    real[np.searchsorted(start, begins[1:] - 1)] = False
    return start[real], end[real]


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of at most ``LONG`` bytes."""
    out = (end - start).astype(np.uint64)
    at = np.arange(len(start))
    for j in range(LONG):
        at = at[start[at] + j < end[at]]
        if not len(at):
            break
        out[at] += (data[start[at] + j].astype(np.uint64) + np.uint64(1)) * _POWERS[j]
    return mix(out)


def _spelt(unit: bytes) -> str:
    return unit.decode("utf-8", "replace").replace(" ", _SPACE)


def merge_encoder(path: str, dropout: float = DROPOUT, seed: int = 0) -> MergeEncoder:
    key = (path, dropout, seed)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = MergeEncoder(path, dropout, seed)
    return _encoders[key]


def _pieces(path: str) -> Pieces:
    if path not in _decoders:
        _decoders[path] = Pieces(path)
    return _decoders[path]


def _prefixed(texts: list[bytes | None]) -> list[bytes]:
    """Encoding puts a space before a text that is not empty."""
    return [b" " + t if t else b"" for t in texts]


def encode_pieces(
    docs: DataFrame,
    model: str,
    dropout: float = DROPOUT,
    seed: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, n_pieces, ids`` (little-endian unsigned 32-bit) of each text.

    The same seed gives the same ids; without dropout they are those of the library, but for a literal
    U+2581. Null and empty texts have no pieces. A null ``doc_id`` stays null and counts as the largest
    in the draws. Repeated rows are encoded alike. Other columns are left out.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merge_encoder(model, dropout, seed)
        for batch in batches:
            for part in chunks(batch, text):
                salts = mix(filled_ids(part.column(doc_id), LAST_ID).astype(np.uint64))
                ids, offsets = own.encode(_prefixed(text_bytes(part.column(text))), salts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(doc_id).cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()), binary_column(ids, offsets)],
                    names=["doc_id", "n_pieces", "ids"],
                )
            release()

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, "doc_id long, n_pieces long, ids binary")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with ``text``, what its ``ids`` stand for; null or empty ids give an empty text.

    An input column named ``text`` gives way, all others stay.
    """
    ship(encoded.sparkSession)
    schema = with_fields(encoded.schema, T.StructField("text", T.StringType()))
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            for part in chunks(batch, "ids", 4 << 20):
                texts = [pieces.decode(np.frombuffer(x or b"", dtype="<u4").astype(np.int64)) for x in part.column("ids").to_pylist()]
                made = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([made if n == "text" else part.column(n) for n in names], names=names)

    return encoded.mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, model: str, **options) -> DataFrame:
    """``doc_id, n_pieces, ids, text``: what the texts are encoded to, and what that is decoded to."""
    return decode_pieces(encode_pieces(docs, model, **options), model)
