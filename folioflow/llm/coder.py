"""Context-mixing range coder for token ids, in numpy, many blocks in lockstep.

A run of ids is cut into blocks of BLOCK ids. Every model is reset with its block, so any block can be decoded without
the others; all blocks of a segment are coded side by side, one id of each at a time.

Ids are coded by rank: the segment's distinct ids, most frequent first, are listed once in its header. Three orders
predict each rank:

- order 2 and order 1 each predict the rank that last followed the same two or the same one before it;
- order 0 holds adaptive frequencies of the rank's digits to base 256, the lower one apart for ranks from 256 on.

Whether order 2 or order 1 holds, or the rank is left to order 0, is estimated three times: by the recent hits of both
orders and whether they agree, by those of order 2 alone, and by those of order 1 alone. The estimates are mixed with
weights that grow with the chance that each gave to what came. All counts start from fixed priors at the head of a
block and are taken up at the places of EPOCHS, so that whole stretches are modelled at once. The mixed decision and
the digits make one interval of a range coder with 64 bits of state. All arithmetic is on integers, so decoding repeats
encoding exactly.

Segment, little-endian: magic, ids, blocks, distinct ids, the distinct ids, per block the number of 16-bit words of its
code and the CRC-32 of its ids, CRC-32 of all these and the codes, then the codes. Ids are unsigned, 32 bits.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDC2"
BLOCK = 2048
EPOCHS = (0, 64, 320, BLOCK)
_U = np.uint64
_SLOTS1, _SLOTS2 = 256, 512
_DECIDE, _DIGIT = 12, 10  # bits of the decision's and of a digit's frequencies; together 12 + 2 * 10 = 32
_ONE, _ALL = 1 << _DECIDE, 1 << _DIGIT
_GAIN = 8  # what one occurrence adds to a digit's count
_FEW = 1 << 22
_STEPS = 128  # coded from one set of arrays, which bounds their size
_LOW = _U(1 << 48)


class Corrupt(ValueError):
    """A segment whose bytes do not match its checksums."""


def _prior(tables: int) -> np.ndarray:
    """Counts of 256 digits at the head of a block: small digits first where a digit leads, even below it."""
    out = np.ones((tables, 256), np.int32)
    out[0] += 160 // (1 + np.arange(256))
    out[1::2] += 96 // (4 + np.arange(256))
    return out


class _Model:
    """Counts of every block: digits[lane, table, 256], outcomes[lane, 64 contexts, 3], weights of three estimates."""

    def __init__(self, lanes: int, pairs: int):
        self.lanes, self.tables = lanes, 4 * pairs - 1
        self.lane = np.arange(lanes, dtype=np.int32)
        self.digits = np.broadcast_to(_prior(self.tables), (lanes, self.tables, 256)).copy()
        self.outcomes = np.empty((lanes, 8, 4, 2, 3), np.int32)  # hits of order 2, hits of order 1, agreement, outcome
        self.outcomes[:] = (1, 1, 4)
        self.weights = np.full((lanes, 3), 85, np.int32)
        self.refresh()

    def _estimates(self):
        n = self.outcomes
        for part in (n, n.sum(2, keepdims=True, dtype=np.int32), n.sum(1, keepdims=True, dtype=np.int32)):
            whole = part[..., :1] + part[..., 1:2] + part[..., 2:]
            yield part[..., :2] * np.int32(_ONE - 4) // whole + 1

    def refresh(self) -> None:
        """Frequencies for the next stretch: shares[lane * 64 + context] packs order 2's high and order 1's low; cum[lane, table, 257]."""
        whole = self.weights.sum(1)
        mixed = sum(e * self.weights[:, k, None, None, None, None] for k, e in enumerate(self._estimates())) // whole[:, None, None, None, None]
        self.shares = (mixed[..., 0] << 16 | mixed[..., 1]).reshape(-1).astype(np.int32)
        run = np.cumsum(self.digits, axis=2, dtype=np.int32)
        self.cum = np.zeros((self.lanes, self.tables, 257), np.int16)
        self.cum[:, :, 1:] = run * np.int32(_ALL - 256) // run[:, :, -1:]
        self.cum += np.arange(257, dtype=np.int16)

    def learn(self, context, outcome, digits, free) -> None:
        """Take up a stretch of all lanes, given as [steps, lanes] arrays; digits are [table, digit] pairs."""
        spot = (self.lane * 64 + context) * 3 + outcome
        seen = np.bincount(spot.ravel(), minlength=self.outcomes.size).astype(np.int32).reshape(self.outcomes.shape)
        scores = [((np.concatenate([e, _ONE - e.sum(-1, keepdims=True)], -1)) * seen).sum((1, 2, 3, 4)) for e in self._estimates()]
        self.weights = np.stack([self.weights[:, k] * (s // max(1, len(context)) + 1) for k, s in enumerate(scores)], 1).astype(np.int64)
        self.weights = (self.weights * 255 // self.weights.sum(1, keepdims=True) + 1).astype(np.int32)
        self.outcomes += 4 * seen
        own = np.broadcast_to(self.lane * (self.tables * 256), context.shape)[free]
        for table, digit in digits:
            got = np.bincount(own + (table[free] if isinstance(table, np.ndarray) else table) * 256 + digit[free], minlength=self.digits.size)
            self.digits += got.astype(np.int32).reshape(self.digits.shape) * _GAIN


def _slot1(last):
    return last & (_SLOTS1 - 1)


def _slot2(prev, last):
    return (prev * 13 + last) & (_SLOTS2 - 1)


def _digits(rank: np.ndarray, pairs: int) -> list:
    """(table, digit) of each digit, the highest first: one table for the first, then one for a digit below zeros and one for others."""
    out, above = [], None
    for k in range(2 * pairs):
        shift = 8 * (2 * pairs - 1 - k)
        out.append((0 if k == 0 else 2 * k - 1 + (above > 0), (rank >> shift) & 255))
        above = rank >> shift
    return out


def _ranks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, most frequent first, and each id's place among them."""
    if int(ids.max()) < _FEW:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        values = values[np.argsort(-counts[values], kind="stable")]
        place = np.zeros(len(counts), np.int32)
        place[values] = np.arange(len(values), dtype=np.int32)
        return values, place.take(ids)
    values, where, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(values), np.int32)
    place[order] = np.arange(len(values), dtype=np.int32)
    return values[order], place.take(where)


def _pairs(distinct: int) -> int:
    return 1 if distinct <= 1 << 16 else 2


class _Writer:
    """One range coder for each lane. The top word is written in every turn and only kept (by moving on) where it is settled."""

    def __init__(self, lanes: int, pairs: int):
        self.most = 3 * BLOCK * pairs + 8
        self.words, self.at = np.zeros(lanes * self.most, np.int32), np.arange(lanes) * self.most
        self.low, self.span = np.zeros(lanes, np.uint64), np.full(lanes, ~_U(0))

    def put(self, live: int, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow the first `live` lanes to [start, start + size) of 2**32."""
        low, span, at = self.low[:live], self.span[:live], self.at[:live]
        unit = span >> _U(32)
        new = low + unit * start[:live]
        over = np.flatnonzero(new < low)
        if len(over):
            self.words[at[over] - 1] += 1  # a carry; settled at the end
        low[:] = new
        np.multiply(unit, size[:live], out=span)
        while (small := span < _LOW).any():
            self.words[at] = low >> _U(48)
            at += small
            shift = small * _U(16)
            low <<= shift
            span <<= shift

    def finish(self) -> tuple[np.ndarray, bytes]:
        """Words of each lane, and the code."""
        for shift in (48, 32, 16, 0):
            self.words[self.at] = (self.low >> _U(shift)) & _U(0xFFFF)
            self.at += 1
        words = self.words.reshape(-1, self.most)
        count = self.at - np.arange(len(words)) * self.most
        most = int(count.max())
        for k in range(most - 1, 0, -1):
            words[:, k - 1] += words[:, k] >> 16
            words[:, k] &= 0xFFFF
        return count, words[:, :most].astype("<u2")[np.arange(most)[None, :] < count[:, None]].tobytes()


def _followers(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What order 1 and order 2 predict at each place: the rank that last followed the same slot of its block, -1 for none."""
    lanes = grid.shape[1]
    lane = np.arange(lanes, dtype=np.int32)
    last, prev = np.zeros_like(grid), np.zeros_like(grid)
    last[1:], prev[2:] = grid[:-1], grid[:-2]
    at1, at2 = _slot1(last) + lane * _SLOTS1, _slot2(prev, last) + lane * _SLOTS2
    small = np.int16 if int(grid.max()) < 1 << 15 else np.int32
    table1, table2, own = np.full(lanes * _SLOTS1, -1, small), np.full(lanes * _SLOTS2, -1, small), grid.astype(small)
    last, prev = np.empty_like(own), np.empty_like(own)
    for t in range(BLOCK):
        table1.take(at1[t], out=last[t], mode="clip")
        table2.take(at2[t], out=prev[t], mode="clip")
        table1[at1[t]] = own[t]
        table2[at2[t]] = own[t]
    return last, prev


def _contexts(hit2: np.ndarray, hit1: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Three last hits of order 2, two of order 1, and whether both predict the same, as a number below 64."""
    out = same.astype(np.int32)
    for hits, far, place in ((hit2, 3, 3), (hit1, 2, 1)):
        for k in range(1, far + 1):
            out[k:] |= hits[:-k].astype(np.int32) << (place + k - 1)
    return out


def _nested(start, size, digits, cum, spot):
    """Narrow start and size (of a stretch with 20 bits below) by two digits."""
    (t1, d1), (t2, d2) = digits
    at = spot + t1 * 257 + d1
    s1, f1 = cum.take(at), cum.take(at + 1)
    f1 -= s1
    at = spot + t2 * 257 + d2
    s2, f2 = cum.take(at), cum.take(at + 1)
    f2 -= s2
    inner = size * f1
    return (start << 2 * _DIGIT) + ((size * s1) << _DIGIT) + inner * s2, inner * f2


def _write(out: _Writer, model: _Model, context, outcome, grid, pairs: int, last: int) -> None:
    """Code some steps of all lanes; the last lane has `last` of them left."""
    free, digits = outcome == 2, _digits(grid, pairs)
    shares = model.shares.take(model.lane * 64 + context)
    low2, low1 = shares >> 16, shares & 0xFFFF
    start = np.where(outcome == 0, 0, np.where(outcome == 1, low2, low2 + low1)).astype(np.int64)
    size = np.where(outcome == 0, low2, np.where(outcome == 1, low1, _ONE - low2 - low1)).astype(np.int64)
    place = np.broadcast_to(model.lane * (model.tables * 257), context.shape)
    s, f = _nested(start, size, digits[:2], model.cum, place)
    steps = [(np.where(free, s, start << 2 * _DIGIT).view(np.uint64), np.where(free, f, size << 2 * _DIGIT).view(np.uint64))]
    if pairs == 2:
        s, f = _nested(np.int64(0), np.int64(_ONE), digits[2:], model.cum, place)
        steps.append((np.where(free, s, 0).view(np.uint64), np.where(free, f, 1 << 32).view(np.uint64)))
    for t in range(len(grid)):
        live = grid.shape[1] - (t >= last)
        for s, f in steps:
            out.put(live, s[t], f[t])


def encode(ids: np.ndarray) -> bytes:
    """One segment holding the ids (unsigned, below 2**32, any number of distinct ones)."""
    ids = np.ascontiguousarray(ids).astype(np.uint32, copy=False)
    n, lanes = len(ids), -(-len(ids) // BLOCK)
    if not n:
        head = struct.pack("<III", 0, 0, 0)
        return MAGIC + head + struct.pack("<I", zlib.crc32(head))
    values, ranks = _ranks(ids)
    pairs = _pairs(len(values))
    flat = np.zeros(lanes * BLOCK, np.int32)
    flat[:n] = ranks
    grid = flat.reshape(lanes, BLOCK).T.copy()
    last = n - BLOCK * (lanes - 1)
    guess1, guess2 = _followers(grid)
    hit1, hit2 = guess1 == grid, guess2 == grid
    context = _contexts(hit2, hit1, guess1 == guess2)
    del guess1, guess2
    outcome = np.where(hit2, 0, np.where(hit1, 1, 2)).astype(np.int8)
    del hit1, hit2
    model, out = _Model(lanes, pairs), _Writer(lanes, pairs)
    for a, b in zip(EPOCHS, EPOCHS[1:], strict=False):
        for k in range(a, b, _STEPS):
            _write(out, model, context[k : min(k + _STEPS, b)], outcome[k : min(k + _STEPS, b)], grid[k : min(k + _STEPS, b)], pairs, last - k)
        if b < BLOCK:
            model.learn(context[a:b], outcome[a:b], _digits(grid[a:b], pairs), outcome[a:b] == 2)
            model.refresh()
    count, body = out.finish()
    raw = ids.astype("<u4").tobytes()
    sums = np.array([zlib.crc32(raw[4 * BLOCK * k : 4 * BLOCK * (k + 1)]) for k in range(lanes)], "<u4")
    head = struct.pack("<III", n, lanes, len(values)) + values.astype("<u4").tobytes() + count.astype("<u4").tobytes() + sums.tobytes()
    return MAGIC + head + struct.pack("<I", zlib.crc32(body, zlib.crc32(head))) + body


def _lookup(cum: np.ndarray) -> np.ndarray:
    """Digit of each of the 2**_DIGIT values, for every lane and table."""
    digit = np.broadcast_to(np.arange(256, dtype=np.uint8), (*cum.shape[:2], 256))
    return np.repeat(digit.reshape(-1), np.diff(cum, axis=2).reshape(-1))


class _Reader:
    """The range decoders of all lanes."""

    def __init__(self, body: np.ndarray, starts: np.ndarray):
        self.body, self.at, self.span = body, starts + 4, np.full(len(starts), ~_U(0))
        self.code = np.zeros(len(starts), np.uint64)
        for k in range(4):
            self.code = (self.code << _U(16)) | body[starts + k]

    def value(self) -> np.ndarray:
        self.unit = self.span >> _U(32)
        return (self.code // self.unit).view(np.int64)

    def took(self, start: np.ndarray, size: np.ndarray) -> None:
        self.code -= self.unit * start.view(np.uint64)
        np.multiply(self.unit, size.view(np.uint64), out=self.span)
        while (small := self.span < _LOW).any():
            shift = small * _U(16)
            self.code <<= shift
            self.code |= self.body.take(self.at, mode="clip") * small
            self.span <<= shift
            self.at += small


def _digit_pair(rest, size, first, second, above, cum, lookup, spot, slot):
    """Two digits from what is left of the value inside a stretch of `size` with 20 bits below, with the start and size of their interval.

    The first digit comes from the table `first`, the next from `second` or, below any digit but 0, from the one after it.
    """
    wide = size << _DIGIT
    d1 = lookup.take(slot + first * _ALL + (rest / wide).astype(np.int64), mode="clip")
    at = spot + first * 257 + d1
    s1 = cum.take(at, mode="clip")
    start = wide * s1
    inner = size * (cum.take(at + 1, mode="clip") - s1)
    table = second + ((d1 > 0) | above)
    d2 = lookup.take(slot + table * _ALL + ((rest - start) / inner).astype(np.int64), mode="clip")
    at = spot + table * 257 + d2
    s2 = cum.take(at, mode="clip")
    return d1 * np.int32(256) + d2, start + inner * s2, inner * (cum.take(at + 1, mode="clip") - s2)


def decode(data: bytes, only: list[int] | None = None) -> np.ndarray:
    """The ids of a segment, or of some of its blocks; raises Corrupt when a checksum fails."""
    if data[:4] != MAGIC or len(data) < 20:
        raise Corrupt("not a segment")
    n, lanes, distinct = struct.unpack_from("<III", data, 4)
    end = 16 + 4 * distinct + 8 * lanes
    if len(data) < end + 4 or zlib.crc32(data[end + 4 :], zlib.crc32(data[4:end])) != struct.unpack_from("<I", data, end)[0]:
        raise Corrupt("checksum of the code")
    if not n:
        return np.zeros(0, np.uint32)
    values = np.frombuffer(data, "<u4", distinct, 16)
    count, sums = np.frombuffer(data, "<u4", lanes, end - 8 * lanes).astype(np.int64), np.frombuffer(data, "<u4", lanes, end - 4 * lanes)
    body = np.frombuffer(data, "<u2", -1, end + 4).astype(np.uint64)
    sizes = np.full(lanes, BLOCK)
    sizes[-1] = n - BLOCK * (lanes - 1)
    starts = np.concatenate([[0], np.cumsum(count)])[:-1]
    if only is not None:
        starts, sizes, sums = starts[only], sizes[only], sums[only]
        lanes = len(only)
    pairs = _pairs(distinct)
    model, code = _Model(lanes, pairs), _Reader(body, starts)
    lane = model.lane
    base1, base2, base_c = lane * _SLOTS1, lane * _SLOTS2, lane * 64
    spot, slot = lane.astype(np.int64) * (model.tables * 257), lane.astype(np.int64) * (model.tables * _ALL)
    small = np.int16 if distinct <= 1 << 15 else np.int32
    table1, table2 = np.full(lanes * _SLOTS1, -1, small), np.full(lanes * _SLOTS2, -1, small)
    grid = np.zeros((BLOCK, lanes), np.int32)
    prev, last = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    past = np.zeros(lanes, np.int32)  # recent hits, where a context keeps them
    done, short = np.flatnonzero(sizes < BLOCK), int(sizes.min())
    for a, b in zip(EPOCHS, EPOCHS[1:], strict=False):
        cum, lookup = model.cum.reshape(-1), _lookup(model.cum)
        kept, what = np.zeros((b - a, lanes), np.int32), np.full((b - a, lanes), 2, np.int32)
        for t in range(a, b):
            at1, at2 = base1 + _slot1(last), base2 + _slot2(prev, last)
            guess1, guess2 = table1.take(at1), table2.take(at2)
            context = past + (guess1 == guess2)
            shares = model.shares.take(base_c + context)
            low2 = (shares >> 16).astype(np.int64)
            both = low2 + (shares & 0xFFFF)
            value = code.value()
            begin = both << 2 * _DIGIT
            rest = value - begin
            now, s, width = _digit_pair(rest, _ONE - both, 0, 1, False, cum, lookup, spot, slot)
            begin += s
            hits = np.flatnonzero(rest < 0)  # where order 2 or 1 holds, the digits go
            two = (value[hits] >> 2 * _DIGIT) < low2[hits]
            begin[hits] = np.where(two, 0, low2[hits]) << 2 * _DIGIT
            width[hits] = np.where(two, low2[hits], both[hits] - low2[hits]) << 2 * _DIGIT
            if t >= short:  # the last block has come to its end and stands still
                begin[done], width[done], code.code[done] = 0, 1 << 32, 0
            code.took(begin, width)
            if pairs == 2:
                value = code.value()
                more, s, width = _digit_pair(value, np.int64(_ONE), 3 + (now > 0), 5, now > 0, cum, lookup, spot, slot)
                s[hits], width[hits] = 0, 1 << 32
                if t >= short:
                    s[done], width[done] = 0, 1 << 32
                code.took(s, width)
                now = (now << 16) + more
            now[hits] = np.where(two, guess2[hits], guess1[hits])
            grid[t] = now
            table1[at1] = now
            table2[at2] = now
            past = ((past << 1) & 0b110100) | ((now == guess2) * np.int32(8)) | ((now == guess1) * np.int32(2))
            kept[t - a] = context
            what[t - a, hits] = ~two
            prev, last = last, now
        if b < BLOCK:
            model.learn(kept, what, _digits(grid[a:b], pairs), what == 2)
            model.refresh()
    out = values.take(grid.T, mode="clip")
    blocks = [out[k, : sizes[k]] for k in range(lanes)]
    for own, crc in zip(blocks, sums, strict=True):
        if zlib.crc32(own.tobytes()) != crc:
            raise Corrupt("checksum of a block")
    return np.concatenate(blocks)
