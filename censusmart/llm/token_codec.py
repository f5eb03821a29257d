"""Context-mixing range coder for blocks of token ids.

The ids of a call share one model, which is written once before the first block; every block of up to ``BLOCK`` ids is
coded on its own with it. For every id the model mixes three predictions into one distribution: the id that most
often follows the same two ids (order 2), the id that most often follows the same id (order 1), and the
frequencies of the ids (order 0; rare ones are rounded to powers of two and share groups). How much mass orders 2 and 1 get, in 16ths,
follows how often they are right; contexts that save less than they cost to write have none. A carryless range coder
with a 52-bit window and 24-bit words codes the id in one step.

The model does not change while ids are coded, so that the encoder looks all intervals up at once, and the decoder needs no
updates. The blocks of a call are coded side by side: every NumPy operation advances all blocks by one id. Window and
range are whole numbers below 2**53 in the decoder's floating point: its products are exact, and so are its quotients after rounding down.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

BLOCK = 4096
MAX_ID = 1 << 19
_UNITS_BITS, _MASS_BITS = 20, 4   # order 0 is counted in 2**20 units, masses in 16ths of the total of 2**24
_TOTAL_BITS = _UNITS_BITS + _MASS_BITS
_FINE = 6                         # frequencies of 2**6 units and more are multiples of it
_WORD, _LOW = 24, 28              # a word leaves the window when the range is below 2**28
_SLOT_BITS = 16
_CHUNK = 64                       # blocks whose intervals are looked up together
_MODEL = struct.Struct("<IIIIII")
_COST = 40                        # bits that a context's prediction must save


def _masses() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By the masses of orders 2 and 1 (4 bits each): the end of order 2, the end of order 1, 16ths left to order 0."""
    two, one = np.arange(256) >> 4, np.arange(256) & 15
    one = one * (16 - two) // 16
    return two << _UNITS_BITS, (two + one) << _UNITS_BITS, 16 - two - one


_END2, _END1, _LEFT = _masses()


def _slots(before1: np.ndarray, before2: np.ndarray) -> np.ndarray:
    return (before1 * 0x9E3779B1 + before2 * 0x85EBCA6B >> 12) & (1 << _SLOT_BITS) - 1


def _quantized(counts: np.ndarray) -> np.ndarray:
    """A code per id: 0 absent, 1 to 6 a frequency of 2**(code - 1) units, above that (code - 6) * 64 units."""
    codes = np.zeros(len(counts), np.uint16)
    at = np.flatnonzero(counts)
    exact = counts[at] * ((1 << _UNITS_BITS) / max(counts.sum(), 1))
    while len(at):
        fine = np.rint(exact / (1 << _FINE)).astype(np.int64)
        small = np.clip(np.rint(np.log2(np.maximum(exact, 1))), 0, _FINE - 1).astype(np.int64)
        codes[at] = np.where(exact >= 1 << _FINE, fine + _FINE, small + 1)
        left = (1 << _UNITS_BITS) - _Order0.total(codes)
        if left >= 0:
            top = at[np.argmax(exact)]
            if codes[top] > _FINE:
                codes[top] += left >> _FINE
            break
        exact = exact * 0.98
    return codes


class _Order0:
    """Ids by frequency: groups of one id, then of all ids of the same small frequency."""

    @staticmethod
    def _groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rare = np.bincount(codes[codes <= _FINE], minlength=_FINE + 1)[:0:-1]
        return rare, (rare << np.arange(_FINE)[::-1]) + (1 << _FINE) - 1 >> _FINE << _FINE

    @classmethod
    def total(cls, codes: np.ndarray) -> int:
        return int((codes[codes > _FINE].astype(np.int64) - _FINE).sum() << _FINE) + int(cls._groups(codes)[1].sum())

    def __init__(self, codes: np.ndarray):
        if self.total(codes) > 1 << _UNITS_BITS:
            raise ValueError("the model is damaged")
        common, (rare, padded) = np.flatnonzero(codes > _FINE), self._groups(codes)
        self.order = np.concatenate([common, *(np.flatnonzero(codes == c) for c in range(_FINE, 0, -1)), [0]])
        units = np.concatenate([(codes[common].astype(np.int64) - _FINE) << _FINE, padded])
        self.start = np.concatenate([[0], np.cumsum(units)[:-1]])
        self.shift = np.concatenate([np.full(len(common), 40), np.arange(_FINE)[::-1]])
        self.size = np.concatenate([units[:len(common)], 1 << np.arange(_FINE)[::-1]])
        self.first = np.concatenate([np.arange(len(common)), len(common) + np.cumsum(rare) - rare])
        # By 64 units: how far to shift a place, and what to add to get its number in ``order``; groups begin at multiples of 64.
        cells = np.append(np.repeat(np.arange(len(units)), units >> _FINE), len(units) - 1)
        self.shift, self.base = self.shift[cells], (self.first - (self.start >> self.shift))[cells]

    def by_number(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of the ids in ``order``, in units."""
        members = np.diff(np.append(self.first, len(self.order) - 1))
        nth = np.arange(len(self.order) - 1) - np.repeat(self.first, members)
        sizes = np.repeat(self.size, members)
        return np.append(np.repeat(self.start, members) + nth * sizes, 0), np.append(sizes, 1)

    def by_id(self, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, size) of every id, in units."""
        starts, sizes = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        for table, values in zip((starts, sizes), self.by_number()):
            table[self.order[:-1]] = values[:-1]
        return starts, sizes


def _followers(keys: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """(context, its most frequent next id, how often, occurrences of the context) of keys that end in ``bits`` bits of the next id."""
    keys.sort()
    starts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
    counts = np.diff(np.append(starts, len(keys)))
    keys = keys[starts].astype(np.int64)
    of = keys >> bits
    begins = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1)
    most = np.maximum.reduceat(counts, begins)
    best = np.flatnonzero(counts == np.repeat(most, np.diff(np.append(begins, len(of)))))
    best = best[np.searchsorted(best, begins)]
    return of[begins], keys[best] & (1 << bits) - 1, most, np.add.reduceat(counts, begins)


def _worth(hits: np.ndarray, of: np.ndarray, without: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mass of a prediction, and whether it pays to write it; ``without``: its id's probability otherwise."""
    share = hits / of
    mass = np.clip(np.rint(16 * (share - without) / np.maximum(1 - without, 1e-9)), 1, 15)
    right, wrong = mass / 16 + (1 - mass / 16) * without, 1 - mass / 16
    gain = hits * np.log2(right / np.maximum(without, 1e-9)) + (of - hits) * np.log2(wrong)
    return mass.astype(np.int64), gain > _COST


class _Model:
    """Frequencies, and the predictions of orders 1 (by id) and 2 (by slot): id * 16 + mass, 0 where there is none."""

    def __init__(self, codes: np.ndarray, one: np.ndarray, two: np.ndarray):
        self.codes, self.one, self.two = codes, one, two
        self.order0 = _Order0(codes)

    @classmethod
    def of(cls, ids: np.ndarray, vocabulary: int) -> _Model:
        one, two, last = np.zeros(vocabulary, np.int64), np.zeros(1 << _SLOT_BITS, np.int64), np.zeros(1 << _SLOT_BITS, np.int64)
        bits = max(int(vocabulary - 1).bit_length(), 1)
        counts = np.zeros(vocabulary, np.int64)
        keys1, keys2 = (np.empty(len(ids), np.uint32 if bits <= 32 - _SLOT_BITS else np.int64) for _ in range(2))
        for at, part, before1, slots in _parts(ids):
            counts += np.bincount(part, minlength=vocabulary)
            keys1[at:at + len(part)] = before1 << bits | part
            keys2[at:at + len(part)] = slots << bits | part
            last[slots] = before1
        codes = _quantized(counts)
        share = _Order0(codes).by_id(vocabulary)[1] / (1 << _UNITS_BITS)
        context, best, hits, n = _followers(keys1, bits)
        del keys1
        mass, pays = _worth(hits, n, share[best])
        one[context[pays]] = (best << _MASS_BITS | mass)[pays]
        context, best, hits, n = _followers(keys2, bits)
        lower = one[last[context]]
        mass1 = (lower & 15) / 16
        mass, pays = _worth(hits, n, np.where(lower >> _MASS_BITS == best, mass1, 0) + (1 - mass1) * share[best])
        two[context[pays]] = (best << _MASS_BITS | mass)[pays]
        return cls(codes, one, two)

    def written(self) -> bytes:
        tables = [np.flatnonzero(t) for t in (self.codes, self.one, self.two)]
        parts = b"".join([np.diff(at, prepend=0).astype("<u4").tobytes() for at in tables]
                         + [self.codes[tables[0]].astype("<u2").tobytes()]
                         + [t[at].astype("<u4").tobytes() for t, at in zip((self.one, self.two), tables[1:])])
        packed = zlib.compress(parts, 6)
        packed += bytes(-len(packed) % 4)
        return _MODEL.pack(len(packed), len(parts), *map(len, tables), zlib.crc32(packed)) + packed

    @classmethod
    def read(cls, content: bytes, vocabulary: int) -> tuple[_Model, int]:
        """The model at the start of ``content``, and its length; raises ValueError if it is damaged."""
        if len(content) < _MODEL.size:
            raise ValueError("the model is cut off")
        size, length, *counts, crc = _MODEL.unpack_from(content)
        packed = content[_MODEL.size:_MODEL.size + size]
        if zlib.crc32(packed) != crc or length != 4 * (2 * sum(counts) - counts[0]) + 2 * counts[0]:
            raise ValueError("the model is damaged")
        parts = zlib.decompressobj().decompress(packed, length)
        tables, at = [], 0
        for n in counts:
            tables.append(np.cumsum(np.frombuffer(parts, "<u4", n, at), dtype=np.int64))
            at += 4 * n
        codes, one, two = np.zeros(vocabulary, np.uint16), np.zeros(vocabulary, np.int64), np.zeros(1 << _SLOT_BITS, np.int64)
        for table, places, kind in zip((codes, one, two), tables, ("<u2", "<u4", "<u4")):
            if len(places) and places[-1] >= len(table):
                raise ValueError("the model is of another vocabulary")
            table[places] = np.frombuffer(parts, kind, len(places), at)
            at += table[places].size * int(kind[-1])
        return cls(codes, one, two), _MODEL.size + size


def _lengths(n: int) -> list[int]:
    return [BLOCK] * (n // BLOCK) + [n % BLOCK] * (n % BLOCK > 0)


def _before(ids: np.ndarray, n: int) -> np.ndarray:
    """For every id the one ``n`` places before it in its block, or 0."""
    before = np.concatenate([np.zeros(n, ids.dtype), ids[:-n]])[:len(ids)]
    for i in range(n):
        before[i::BLOCK] = 0
    return before


def _parts(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(where it begins, ids, the ids before them, order-2 slots) of every ``_CHUNK`` blocks."""
    for at in range(0, len(ids), _CHUNK * BLOCK):
        part = ids[at:at + _CHUNK * BLOCK].astype(np.int64)
        before1 = _before(part, 1)
        yield at, part, before1, _slots(before1, _before(part, 2))


def _intervals(model: _Model, ids: np.ndarray, before1: np.ndarray, slots: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the ids in their distributions, by the first prediction that names the id; ``starts``, ``sizes``: of order 0, by id."""
    two, one = model.two.take(slots), model.one.take(before1)
    masses = (two & 15) << _MASS_BITS | (one & 15)
    end2, end1, left = _END2.take(masses), _END1.take(masses), _LEFT.take(masses)
    right2 = (two >> _MASS_BITS == ids) & (end2 > 0)
    right1 = (one >> _MASS_BITS == ids) & (end1 > end2)
    start = np.where(right2, 0, np.where(right1, end2, end1 + left * starts.take(ids)))
    return start, np.where(right2, end2, np.where(right1, end1 - end2, left * sizes.take(ids)))


def encode(ids: np.ndarray, vocabulary: int) -> list[bytes]:
    """The ids cut into blocks; the first one is preceded by the model."""
    lengths = _lengths(len(ids))
    if not lengths:
        return []
    if ids.min() < 0 or ids.max() >= vocabulary or vocabulary > MAX_ID:
        raise ValueError("id outside the vocabulary")
    lanes, full = len(lengths), len(ids) // BLOCK
    model = _Model.of(ids, vocabulary)
    by_id = model.order0.by_id(vocabulary)
    starts, sizes = np.zeros((BLOCK, lanes), np.int32), np.zeros((BLOCK, lanes), np.int32)
    for at, part, before1, slots in _parts(ids):
        lane, whole = at // BLOCK, min(at // BLOCK + _CHUNK, full)
        for table, values in zip((starts, sizes), _intervals(model, part, before1, slots, *by_id)):
            table[:, lane:whole] = values[:(whole - lane) * BLOCK].reshape(-1, BLOCK).T
            if lane + _CHUNK > full and full < lanes:
                table[:lengths[-1], full] = values[(full - lane) * BLOCK:]
    low, width = np.zeros(lanes, np.int64), np.full(lanes, 1 << _LOW + _WORD, np.int64)
    stride = BLOCK + 8
    words, used = np.zeros(lanes * stride, np.int32), np.arange(lanes) * stride
    for t in range(lengths[0]):
        n = lanes - (t >= lengths[-1])
        unit = width[:n] >> _TOTAL_BITS
        now, unit = low[:n] + unit * starts[t, :n], unit * sizes[t, :n]
        short = unit < 1 << _LOW
        out = np.flatnonzero(short)
        at = used.take(out)
        words[at] = now.take(out) >> _LOW
        used[out] = at + 1
        low[:n] = np.where(short, (now & (1 << _LOW) - 1) << _WORD, now)
        width[:n] = np.where(short, unit << _WORD, unit)
    for part in (low >> _LOW, (low & (1 << _LOW) - 1) >> _LOW - _WORD, (low & (1 << _LOW - _WORD) - 1) << 2 * _WORD - _LOW):
        words[used] = part
        used += 1
    words = words.reshape(lanes, stride)
    used -= np.arange(lanes) * stride
    carry = np.zeros(lanes, np.int32)
    for i in range(int(used.max()) - 1, -1, -1):
        digit = words[:, i] + carry
        carry = digit >> _WORD
        words[:, i] = digit & (1 << _WORD) - 1
    blocks = []
    for i in range(lanes):
        block = words[i, :used[i]].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
        blocks.append(block + bytes(-len(block) % 4))
    return [model.written() + blocks[0], *blocks[1:]]


def decode(blocks: list[bytes], n_ids: int, vocabulary: int) -> np.ndarray:
    """The ids of blocks made by ``encode``."""
    lengths = _lengths(n_ids)
    if len(blocks) != len(lengths):
        raise ValueError("number of blocks and ids disagree")
    if not lengths:
        return np.zeros(0, np.int64)
    if vocabulary > MAX_ID:
        raise ValueError("the vocabulary is too large")
    model, size = _Model.read(blocks[0], vocabulary)
    blocks = [blocks[0][size:], *blocks[1:]]
    lanes = len(blocks)
    stride = max(map(len, blocks)) // 3 + 8
    digits = np.zeros((lanes, stride, 4), np.uint8)
    for i, block in enumerate(blocks):
        n = len(block) // 3
        digits[i, 1:n + 1, :3] = np.frombuffer(block, np.uint8, 3 * n).reshape(n, 3)
    digits = digits.view("<u4").reshape(lanes, stride).astype(np.int64)
    # Words as they enter the window: it holds 4 bits of the first and two words more.
    over = _LOW - _WORD
    digits[:, :-1] = (digits[:, :-1] << over | digits[:, 1:] >> _WORD - over) & (1 << _WORD) - 1
    code = (digits[:, 0] * (1 << 2 * _WORD) + digits[:, 1] * (1 << _WORD) + digits[:, 2]).astype(np.float64)
    words = digits.astype(np.float64).reshape(-1)
    at = np.arange(lanes) * stride + 3
    width = np.full(lanes, float(1 << _LOW + _WORD))
    o = model.order0
    end2s, end1s, lefts, starts, sizes = (x.astype(np.float64) for x in (_END2, _END1, _LEFT, *o.by_number()))
    before1, before2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    table = np.zeros((lengths[0], lanes), np.int32)
    down, floor_of = 0.5 ** _TOTAL_BITS, float(1 << _LOW)
    with np.errstate(all="ignore"):  # damaged blocks, which their checksums tell
        for t in range(lengths[0]):
            n = lanes - (t >= lengths[-1])
            if n < len(code):
                code, width, at, before1, before2 = code[:n], width[:n], at[:n], before1[:n], before2[:n]
                if not n:
                    break
            two, one = model.two.take(_slots(before1, before2)), model.one.take(before1)
            masses = (two & 15) << _MASS_BITS | (one & 15)
            end2, end1, left = end2s.take(masses), end1s.take(masses), lefts.take(masses)
            unit = np.floor(width * down)
            value = np.floor(code / unit)
            inner = ((value - end1) / left).astype(np.int64)
            cell = inner >> _FINE
            number = (inner >> o.shift.take(cell, mode="clip")) + o.base.take(cell, mode="clip")
            ids, start, size = (x.take(number, mode="clip") for x in (o.order, starts, sizes))
            known, by2 = value < end1, value < end2
            ids = np.where(known, np.where(by2, two, one) >> _MASS_BITS, ids)
            low = np.where(known, np.where(by2, 0.0, end2), end1 + left * start)
            size = np.where(known, np.where(by2, end2, end1 - end2), left * size)
            code = code - unit * low
            width = unit * size
            table[t, :n] = ids
            before1, before2 = ids, before1
            short = width < floor_of
            code = np.where(short, code * (1 << _WORD) + words.take(at, mode="clip"), code)
            width = np.where(short, width * (1 << _WORD), width)
            at = at + short
    full = n_ids // BLOCK
    return np.concatenate([table[:, :full].T.reshape(-1), *([table[:lengths[-1], full]] if full < lanes else [])])


def checksum(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
