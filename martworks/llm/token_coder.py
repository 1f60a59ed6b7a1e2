"""Token ids in compressed files: adaptive context mixing and a range coder.

Ids are coded in blocks of BLOCK ids. Each block starts from a fresh model and has a checksum, so any block is read
alone. The model predicts the next id from the two ids before it (order 2), from the one before (order 1) and from
the frequencies so far (order 0): each of the two contexts remembers the id that followed last and how often it was
right, and how far such a prediction is trusted is learned as the block goes on. The three are mixed into one
division of the coder's interval: the part of the order-2 id, the part of the order-1 id, and the rest shared by the
high bytes of ids; after a high byte the low byte follows.

Blocks are worked on side by side, one id of each at a time, in numpy.

File: MAGIC; blocks; the index; its place and length, checksum and MAGIC again. A block is the coder's words of 24
bits. The index holds per block its place, length, number of ids and the checksum of the ids, and per document its id
and number of ids.
"""

from __future__ import annotations

import os
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from martworks.session import scratch

from .common import stored, text_of
from .shingle_arrays import _BASE, _BYTE, PIECE_BYTES, mix64, pieces, text_bytes

MAGIC = b"MWTOKEN2"
END_ID = 2
BLOCK = 2048
LANES = 4096
CELLS = 512
#: High bytes share 2^12 parts; their frequencies are counted anew after so many ids. How right the orders are is looked at
#: every LATE ids.
SHARES, RENEW, LATE = 12, (64, 192, 512, 1024), 64
#: The coder's interval has 24 to 48 bits, so quotients of floats are exact; it moves on by words of 24.
_WORD, _MASK = 24, (1 << 24) - 1
#: How far a prediction that was right so often is trusted, of 2^16.
_TRUST = np.array([0, *[65536 * (k + 1) // (k + 2) for k in range(1, 16)]], np.int32)
#: What both predictions take of the interval at most.
_MOST = 65536 - 4096 - 1


class _Model:
    """The state of all blocks side by side; the coder and the decoder take the same steps. Arrays of two rows are for
    order 1 and order 2."""

    def __init__(self, lanes: int):
        self.lanes, self.step, self.counted = lanes, 0, 0
        lane = np.arange(lanes)
        self.byte = lane * 256
        # Per context the id that followed and, in the lowest four bits, how often it was right.
        # Sixteen cells lie together where memory is fetched at once, 8 of each order: the last id says which sixteen.
        self.base = np.stack([lane * 2 * CELLS, lane * 2 * CELLS + 8])
        self.memory = np.zeros(lanes * 2 * CELLS + 16, np.int32)
        self.memory = self.memory[-self.memory.ctypes.data % 64 // 4:]
        # The share of right predictions of each order of late, of 2^15.
        self.weight, self.right = np.full((2, lanes), 1 << 14, np.int32), np.zeros((2, lanes), np.uint8)
        self.row = np.stack([lane * 32, lane * 32 + 16])
        self._weigh()
        self.counts = np.zeros((lanes, 256), np.int32)
        self._share()
        self.last = self.hash = np.zeros(lanes, np.uint16)

    def _weigh(self) -> None:
        """The trust in a prediction: in its own record, weighed by how right the order has been."""
        self.trust = np.clip(_TRUST * (self.weight.T[:, :, None] >> 3) >> 12, 1, _MOST).astype(np.uint16).ravel()

    def _share(self) -> None:
        """Share the interval's rest out to the high bytes by their frequencies so far."""
        free = (1 << SHARES) - 256
        parts = self.counts * np.int32(free) // np.int32(max(1, self.counted)) + np.int32(1 if self.counted else 1 + free // 256)
        parts[:, 255] += (1 << SHARES) - parts.sum(axis=1, dtype=np.int32)
        self.parts = parts.ravel()
        # Start and size of a high byte's part.
        self.places = ((np.cumsum(parts, axis=1, dtype=np.int32) - parts) << 16 | parts).ravel()

    def symbols(self) -> np.ndarray:
        """For each of the shares, lane by lane, the high byte that owns it."""
        if not self.counted:
            return np.tile(np.repeat(np.arange(256, dtype=np.uint8), self.parts[:256]), self.lanes)
        return np.repeat(np.tile(np.arange(256, dtype=np.uint8), self.lanes), self.parts)

    def predict(self) -> None:
        before, self.hash = self.hash, self.last * np.uint16(40503)
        cells = np.empty((2, self.lanes), np.uint16)
        cells[:] = self.hash >> np.uint16(6)
        cells[0] &= np.uint16(2 * CELLS - 9)
        cells[1] &= np.uint16(2 * CELLS - 16)
        cells[1] |= (before * np.uint16(13849) + self.hash) >> np.uint16(13)
        self.at = self.base + cells
        self.seen = self.memory[self.at]
        self.known = self.seen.astype(np.uint8) & np.uint8(15)
        self.ids = self.seen >> 4
        m1, self.m2 = self.trust[self.row + self.known].astype(np.int64)
        m1 *= _MOST - self.m2
        m1 >>= 16
        m1 += 1
        m1 *= self.ids[0] != self.ids[1]
        self.m1, self.rest = m1, 65536 - self.m2 - m1

    def update(self, ids: np.ndarray, hit: np.ndarray, done: np.ndarray) -> bool:
        """Take in the ids that came (``hit``: whether each order had said so; ``done``: all ids, a row per step);
        whether frequencies were renewed."""
        self.right += hit.view(np.uint8)
        # A count goes up by one to 15, or down by half; where none would be left the new id takes its place.
        known, right = self.known, hit.view(np.uint8)
        change = (right & (known < 15)) - ((known + np.uint8(1)) >> np.uint8(1)) * (right ^ np.uint8(1))
        fresh = known + (right << np.uint8(1)) < 2
        self.memory[self.at] = np.where(fresh, ids << 4 | 1, self.seen + change.view(np.int8))
        self.last = done[self.step]
        self.step += 1
        if self.step % LATE == 0:
            self.weight += (self.right * np.int32(32768 // LATE) - self.weight) >> 1
            self.right[:] = 0
            self._weigh()
        if self.step in RENEW:
            for k in range(0, self.lanes, 64):
                high = done[self.counted:self.step, k:k + 64] >> 8
                counts = self.counts[k:k + 64]
                counts += np.bincount((high + self.byte[:high.shape[1]]).ravel(), minlength=counts.size).reshape(counts.shape).astype(np.int32)
            self.counted = self.step
            self._share()
            return True
        return False


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of an array of shape (blocks, BLOCK) of ids below 2^16, each coded on its own.

    The coder holds the low end of its interval and gives out 24 bits whenever the interval is shorter than 2^24; a
    carry stays with the end until the next word is given out, and is handed on through the words when all are there.
    """
    lanes = len(ids)
    model = _Model(lanes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << 2 * _WORD)
    # A word an id at most and two for the end, and whether there was one.
    words, given = np.empty((BLOCK + 2, lanes), np.int32), np.ones((BLOCK + 2, lanes), bool)
    columns = _turned(ids.astype(np.uint16, copy=False))
    for step, column in enumerate(columns):
        model.predict()
        column = column.astype(np.int32)
        hit = model.ids == column
        first, second = hit
        part = span >> 16
        two, one = model.m2 * part, model.m1 * part
        part *= model.rest
        part >>= SHARES
        place = model.places[model.byte + (column >> 8)]
        byte = part * (place & 0xFFFF)
        byte >>= 8
        part *= place >> 16
        part += byte * (column & 255)
        part += one
        part += two
        low += np.where(second, 0, np.where(first, two, part))
        span = np.where(second, two, np.where(first, one, byte))
        words[step] = low >> _WORD
        short = np.less_equal(span, _MASK, out=given[step])
        shift = short * np.int64(_WORD)
        span <<= shift
        low &= _MASK | (short - np.int64(1))
        low <<= shift
        model.update(column, hit, columns)
    words[BLOCK], words[BLOCK + 1] = low >> _WORD, low & _MASK
    sizes = given.sum(axis=0)
    words = _turned(words).ravel()[_turned(given).ravel()]
    while (over := words >> _WORD).any():
        words &= _MASK
        words[:-1] += over[1:]
    packed = np.ascontiguousarray(words.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3])
    return [x.tobytes() for x in np.split(packed, np.cumsum(sizes)[:-1])]


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The ids of coded blocks, of shape (blocks, BLOCK)."""
    lanes = len(blocks)
    longest = max(2, max(len(b) for b in blocks) // 3) + 1
    packed = np.zeros((lanes, longest, 4), np.uint8)
    for i, b in enumerate(blocks):
        packed[i, :len(b) // 3, :3] = np.frombuffer(b, np.uint8, len(b) // 3 * 3).reshape(-1, 3)
    words = packed.view("<u4").ravel()
    model = _Model(lanes)
    # The next word, and the place of the coded number in the interval.
    at = np.arange(lanes) * longest + 2
    ends = at + longest - 3
    place, span = words[at - 2].astype(np.int64) << _WORD | words[at - 1], np.full(lanes, 1 << 2 * _WORD)
    out = np.zeros((BLOCK, lanes), np.uint16)
    owner = np.arange(lanes) << SHARES
    symbols = model.symbols()
    for step in range(BLOCK):
        model.predict()
        part = span >> 16
        two, one = model.m2 * part, model.m1 * part
        both = two + one
        part *= model.rest
        part >>= SHARES
        second, miss = place < two, place >= both
        # Where a prediction holds, the byte found here does not count.
        both = place - both
        byte = symbols[owner + _number(both, part, (1 << SHARES) - 1)].astype(np.int64)
        found = model.places[model.byte + byte]
        size = part * (found & 0xFFFF)
        size >>= 8
        part *= found >> 16
        both -= part
        lower = _number(both, size, 255)
        both -= lower * size
        byte <<= 8
        byte |= lower
        ids = np.where(miss, byte.astype(np.int32), np.where(second, model.ids[1], model.ids[0]))
        place = np.where(miss, both, np.where(second, place, place - two))
        span = np.where(miss, size, np.where(second, two, one))
        short = span <= _MASK
        shift = short * np.int64(_WORD)
        span <<= shift
        # A damaged block may ask for words it does not have; its checksum will tell.
        place <<= shift
        place |= words[np.minimum(at, ends)] * short
        at += short
        out[step] = ids
        if model.update(ids, model.ids == ids, out):
            symbols = model.symbols()
    return _turned(out)


def _turned(array: np.ndarray) -> np.ndarray:
    """The array with rows for columns, turned in tiles that stay in the cache."""
    out = np.empty(array.shape[::-1], array.dtype)
    for k in range(0, array.shape[0], 64):
        for j in range(0, array.shape[1], 64):
            out[j:j + 64, k:k + 64] = array[k:k + 64, j:j + 64].T
    return out


def _number(place: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Which of the parts of a size a place lies in; the last one for a place before them."""
    return np.minimum((place / size).astype(np.int64).view(np.uint64), np.uint64(most)).view(np.int64)


class Writer:
    """Writes documents' ids to a binary stream; at most LANES blocks are held."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.pending: list[np.ndarray] = []
        self.held = 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[np.ndarray] = []
        self._out(MAGIC)

    def _out(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_ids: np.ndarray, null: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents (id, whether it is null, number of ids) and all their ids, one after the other."""
        self.docs.append(np.stack([doc_ids, null.astype(np.int64), lengths]))
        self.pending.append(ids.astype(np.uint16))
        self.held += len(ids)
        while self.held >= BLOCK * LANES:
            flat = np.concatenate(self.pending)
            self._code(flat[:BLOCK * LANES])
            self.pending, self.held = [flat[BLOCK * LANES:]], len(flat) - BLOCK * LANES

    def _code(self, flat: np.ndarray) -> None:
        n = -(-len(flat) // BLOCK)
        padded = np.zeros(n * BLOCK, np.uint16)
        padded[:len(flat)] = flat
        for i, data in enumerate(encode_blocks(padded.reshape(n, BLOCK))):
            own = flat[i * BLOCK:(i + 1) * BLOCK]
            self.blocks.append((self.at, len(data), len(own), zlib.crc32(own.astype("<u4").tobytes())))
            self._out(data)

    def close(self) -> tuple[int, int]:
        """Number of documents and of ids."""
        if self.held:
            self._code(np.concatenate(self.pending))
        docs = np.concatenate(self.docs, axis=1) if self.docs else np.zeros((3, 0), np.int64)
        blocks = np.array(self.blocks, np.int64).reshape(-1, 4)
        index = zlib.compress(struct.pack("<QQ", len(blocks), docs.shape[1]) + blocks.astype("<i8").tobytes() + docs.astype("<i8").tobytes(), 1)
        place = self.at
        self._out(index)
        self._out(struct.pack("<QQL", place, len(index), zlib.crc32(index)) + MAGIC)
        return docs.shape[1], int(docs[2].sum())


def _part(file, at: int, length: int) -> bytes:
    file.seek(at)
    data = file.read(length)
    if len(data) != length:
        raise ValueError("the token file ends early")
    return data


def read_index(file, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (place, length, ids, checksum) and documents (3 rows: id, null, ids) of a file."""
    tail = _part(file, size - 28, 28)
    place, length, check = struct.unpack("<QQL", tail[:20])
    if tail[20:] != MAGIC:
        raise ValueError("not a token file")
    index = _part(file, place, length)
    if zlib.crc32(index) != check:
        raise ValueError("the index is damaged")
    index = zlib.decompress(index)
    n, docs = struct.unpack("<QQ", index[:16])
    numbers = np.frombuffer(index[16:], "<i8")
    return numbers[:4 * n].reshape(n, 4), numbers[4 * n:].reshape(3, docs)


def read_ids(file, blocks: np.ndarray) -> np.ndarray:
    """All ids of some blocks of a file, held against the checksums."""
    found = decode_blocks([_part(file, int(place), int(length)) for place, length, _, _ in blocks])
    rows = []
    for row, (place, _, n, check) in zip(found, blocks):
        row = row[:n].astype("<u4")
        if zlib.crc32(row.tobytes()) != check:
            raise ValueError(f"the block at {place} is damaged")
        rows.append(row)
    return np.concatenate(rows) if rows else np.zeros(0, "<u4")


def read_documents(file, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Documents of a file in order: ids, null marks and token ids, in groups of about LANES blocks."""
    blocks, docs = read_index(file, size)
    ends, at, done, held = np.cumsum(docs[2]), 0, 0, np.zeros(0, "<u4")
    for k in range(0, len(blocks), LANES):
        held = np.concatenate([held, read_ids(file, blocks[k:k + LANES])])
        upto = int(np.searchsorted(ends, at + len(held), side="right"))
        cuts = ends[done:upto] - at
        if upto > done:
            yield docs[0, done:upto], docs[1, done:upto], np.split(held[:cuts[-1]], cuts[:-1])
            held, at, done = held[cuts[-1]:], int(ends[upto - 1]), upto


def _signs() -> np.ndarray:
    """The character that stands for each byte in the tokens of byte-level tokenizers."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    out = np.arange(256, dtype="<u2")
    out[hidden] = 0x100 + np.arange(len(hidden))
    return out


_SIGN = _signs()
#: Letters, digits and other signs of ASCII; 0 for all other bytes.
_KIND = bytes(0 if not 0x20 < b < 0x7F else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 4 for b in range(256))


def _put(array: np.ndarray, used: int, values: np.ndarray) -> np.ndarray:
    """The array with values behind the used part, longer if need be."""
    n = used + values.shape[-1]
    if n > array.shape[-1]:
        array = np.concatenate([array, np.zeros((*array.shape[:-1], n), array.dtype)], axis=-1)
    array[..., used:n] = values
    return array


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that start somewhere, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class Units:
    """Token ids of texts, with those of each run of a space and the letters after it looked up once.

    A text is cut where the tokenizer's own pattern surely cuts, too, so the pieces' ids together are those of the text:
    before single spaces between characters that are not white space, around single line ends, and between letters,
    digits and other signs (but not after an apostrophe). A piece of one kind of these is one of the pattern's own and
    goes to the tokenizer's model without the pattern; the others go the whole way.
    """

    LIMIT = 1_200_000

    @classmethod
    def of(cls, path: str) -> Units:
        """The one of this worker process: what earlier tasks have looked up need not be looked up again."""
        kept = sys.modules.setdefault("_token_units", types.ModuleType("_token_units")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        if not os.path.isabs(path):
            import public_tokenizers
            path = public_tokenizers.path(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = Tokenizer(self.tokenizer.model)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids have to be below 2^16")
        # Every sign of a token stands for a byte.
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        self.powers = self.inverse = np.zeros(0, np.uint64)
        self._clear()

    def _clear(self) -> None:
        # Of the pieces known: hashes, places and lengths in the bytes, and in the ids; how many of each there are.
        self.hashes, self.places = np.zeros(1 << 14, np.uint64), np.zeros((4, 1 << 14), np.int64)
        self.bytes, self.store = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint16)
        self.known = self.used_bytes = self.used = 0
        # Look-up tables of the hashes from some number on, each less than half as long as the one before.
        self.tables: list = []

    def _powers(self, n: int) -> np.ndarray:
        """Powers of the hashes' base, n of them at least; their inverses are set, too."""
        if len(self.powers) < n:
            n = max(n, 2 * PIECE_BYTES)
            self.powers = np.cumprod(np.full(n, _BASE))
            self.inverse = np.cumprod(np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64))))
        return self.powers

    def _find(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which of the known pieces each piece is, -1 for none; those found are compared byte by byte."""
        at = np.full(len(hashes), -1)
        for start, table in self.tables:
            left = np.flatnonzero(at < 0)
            found = table.get_indexer(hashes[left])
            at[left] = np.where(found < 0, -1, found + start)
        found = np.flatnonzero(at >= 0)
        starts, lengths = self.places[:2, at[found]]
        same = np.array_equal(lengths, sizes[found]) and np.array_equal(
            data[_spread(begin[found], lengths)], self.bytes[_spread(starts, lengths)])
        if not same:  # two pieces of one hash
            self._clear()
            at[:] = -1
        return at

    def _learn(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, whole: np.ndarray) -> None:
        """Look up new pieces, first those of one kind (``whole`` so many), in chains that are told apart by the lengths
        of the ids' bytes, then the others."""
        import pandas as pd

        flat = data[_spread(begin, sizes)]
        ends = np.cumsum(sizes)
        split = int(ends[whole - 1]) if whole else 0
        signs, cuts = _SIGN[flat[:split]].tobytes().decode("utf-16-le"), [0, *ends.tolist()]
        plain = [signs[a:b] for a, b in zip(cuts[:whole], cuts[1:])]
        chains = [plain[i:i + 1000] for i in range(0, whole, 1000)]
        ids = [np.zeros(0, np.uint16)]
        ids += [np.array(e.ids, np.uint16) for e in self.model.encode_batch_fast(chains, is_pretokenized=True, add_special_tokens=False)]
        widths = np.cumsum(self.widths[np.concatenate(ids)])
        lengths = np.diff(np.searchsorted(widths, ends[:whole]) + 1, prepend=0)
        raw = flat[split:].tobytes()
        others = [raw[a - split:b - split].decode() for a, b in zip(cuts[whole:], cuts[whole + 1:])]
        others = [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        lengths = np.append(lengths, [len(x) for x in others]).astype(np.int64)
        places = [self.used_bytes + ends - sizes, sizes, self.used + np.cumsum(lengths) - lengths, lengths]
        ids = np.concatenate(ids + others)
        self.places, self.hashes = _put(self.places, self.known, np.stack(places)), _put(self.hashes, self.known, hashes)
        self.bytes, self.store = _put(self.bytes, self.used_bytes, flat), _put(self.store, self.used, ids)
        start, self.known = self.known, self.known + len(hashes)
        self.used_bytes, self.used = self.used_bytes + len(flat), self.used + len(ids)
        while self.tables and 2 * (self.known - start) >= len(self.tables[-1][1]):
            start = self.tables.pop()[0]
        self.tables.append((start, pd.Index(self.hashes[start:self.known].copy())))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, END_ID after each, and their numbers."""
        import pandas as pd

        data, offsets = text_bytes(texts)
        kind = np.frombuffer(bytearray(data.tobytes().translate(_KIND)), np.uint8)
        cut = np.zeros(len(data) + 1, bool)
        odd = np.zeros(len(data), bool)
        if len(data) > 2:
            # Latin letters of two bytes: U+00C0 to U+024F without the signs of times and division.
            wide = (data >= 0xC3) & (data <= 0xC9)
            wide[:-1] &= (data[:-1] != 0xC3) | ((data[1:] != 0x97) & (data[1:] != 0xB7))
            kind |= wide.view(np.uint8)
            kind[1:] |= wide[:-1].view(np.uint8)
            solid = (data > 0x20) & (data < 0x7F)
            lead = (data >= 0xC3) & (data <= 0xDF)
            before, after = solid.copy(), solid | lead
            before[1:] |= lead[:-1]
            cut[1:-2] = (data[1:-1] == 0x20) & before[:-2] & after[2:]
            some, change = kind > 0, kind[1:] != kind[:-1]
            mark = data[:-1] == 0x27
            cut[1:-1] |= change & some[1:] & some[:-1] & ~mark
            line = (data[1:-1] == 0x0A) & some[:-2]
            cut[1:-2] |= line
            cut[2:-1] |= line & some[2:]
            odd = ~some
            odd[1:] |= change & mark
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        starts, sizes = edges[:-1], np.diff(edges)
        if len(starts):
            hashes = _BYTE[data]
            hashes *= self._powers(len(data))[:len(data)]
            hashes = np.add.reduceat(hashes, starts) * self.inverse[starts]
            codes, hashes = pd.factorize(mix64(hashes + sizes.astype(np.uint64)))
            first = np.zeros(len(hashes), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            begin, sizes = starts[first], sizes[first]
            if self.known + len(hashes) > self.LIMIT or self.used > 16 * self.LIMIT:
                self._clear()
            at = self._find(hashes, data, begin, sizes)
            new = np.flatnonzero(at < 0)
            if len(new):
                odd[starts] &= data[starts] != 0x20
                lengths = sizes[new]
                whole = ~np.logical_or.reduceat(odd[_spread(begin[new], lengths)], np.cumsum(lengths) - lengths)
                new = np.append(new[whole], new[~whole])
                at[new] = self.known + np.arange(len(new))
                self._learn(hashes[new], data, begin[new], sizes[new], int(whole.sum()))
            at = at[codes]
            begins, lengths = self.places[2, at], self.places[3, at]
        else:
            lengths = begins = np.zeros(0, np.int64)
        # Ids of units in order, with a place left for the end of each text.
        sums = np.append(0, np.cumsum(lengths))
        counts = np.diff(sums[np.searchsorted(starts, offsets)]) + 1
        values = self.store[_spread(begins, lengths)]
        out = np.full(int(counts.sum()), END_ID, np.uint16)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(counts) - 1] = False
        out[keep] = values
        return out, counts


def write_files(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", folder: str | None = None) -> DataFrame:
    """Write all documents in ascending order of ``doc_id`` (null last, equal ids by a hash of the text) to one file
    per range; the stored manifest: ``path``, ``docs``, ``ids`` and ``start``, the number of ids in the files before."""
    folder = folder or scratch(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, writer, head = None, None, None
        for batch in batches:
            for piece in pieces(batch, "text"):
                if writer is None:
                    units, head = Units.of(tokenizer), (piece.column("doc_id")[0].as_py(), piece.column("tie")[0].as_py())
                    system, path = pa.fs.FileSystem.from_uri(folder)
                    system.create_dir(path, recursive=True)
                    name = f"{uuid.uuid4().hex}.tokens"
                    stream = system.open_output_stream(f"{path}/{name}")
                    writer = Writer(stream)
                ids, counts = units.ids(piece.column("text"))
                column = piece.column("doc_id")
                writer.add(np.asarray(column.fill_null(0)), np.asarray(column.is_null()), counts, ids)
        if writer is not None:
            n, total = writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({
                "path": [f"{folder}/{name}"], "docs": [n], "ids": [total],
                "first_id": pa.array([head[0]], pa.int64()), "first_tie": pa.array([head[1]], pa.int64())})

    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tie"), text_of().alias("text"))
    sorted_ = given.repartitionByRange(*order).sortWithinPartitions(*order)
    files = stored(sorted_.mapInArrow(run, "path string, docs long, ids long, first_id long, first_tie long"), "token-files")
    # One row per file goes through this window.
    before = Window.orderBy(F.col("first_id").asc_nulls_last(), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "docs", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))


def read_files(manifest: DataFrame, files: int | None = None) -> DataFrame:
    """Per document of the files ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``, all decoded from them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                system, inner = pa.fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as file:
                    for doc_ids, null, parts in read_documents(file, file.size()):
                        lengths = np.array([len(p) for p in parts], np.int64)
                        sums = [zlib.crc32(np.ascontiguousarray(p).tobytes()) for p in parts]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids, mask=null.astype(bool)), pa.array(start + np.cumsum(lengths) - lengths),
                             pa.array(lengths), pa.array(sums, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(lengths.sum())

    # A file a task, as far as hashing allows.
    spread = manifest.repartition(files, "path") if files else manifest.repartition("path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Encode, write and read back all documents. A null text is empty: its only id is the end. Null ids come last
    and stay null; equal ids are documents of their own; an empty table writes no file and gives no rows."""
    manifest = stored(write_files(docs, **options), "token-manifest")
    return read_files(manifest, max(1, manifest.count()))
