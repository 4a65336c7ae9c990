"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks; every block starts from an empty model and empty coders, and carries a checksum, so that any
block can be read alone and damage stays in its block. A block is cut into lanes of ``STEPS`` ids, each with a range coder
of its own; all lanes of a block share one model, and at step t all of them code their t-th id. Lanes are array elements, so one
NumPy operation serves a step of all lanes of many blocks.

An id is coded as one of three outcomes: it is what followed the last two ids before (order 2), or what followed the last id
(order 1), or neither; in the last case by its frequency among the block's ids so far that were neither (order 0), with an
escape to plain bits for ids not met yet. The probabilities of the outcomes mix four predictions: counts by both entries'
confidences, by the order-2 entry's alone, by the order-1 entry's alone, and by none. The mixing weights are posterior weights of the
predictions, by what each would have spent on the ids so far. The tables take in the new ids every 8 steps, and earlier in a
block's first steps; counts, weights and frequencies are renewed as a block doubles, and once in between.

The coder's numbers are whole and below 2**53, so float64 arithmetic on them is exact and every machine decodes alike.

Block layout: "CMR2", number of ids, bits of an id, CRC-32 of the ids (little-endian unsigned 32-bit), the number of digits of
each lane (16 bits each), then the lanes' 16-bit digits, all big-endian from the lanes on.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

MAGIC = b"CMR2"
HEAD = struct.Struct("<4sIII")
STEPS = 1 << 10
BLOCK = 128 * STEPS
MAX_ID = 1 << 18
#: Steps after which the order-1 and order-2 tables take in the new ids, and those after which probabilities and weights are renewed too.
_SPANS = [1, 2, 3, 4, 6, *range(8, STEPS, 8)]
_RENEWALS = frozenset(1 << e for e in range(12)) | {96, 192, 384, 768}
_TWO, _ONE = 15, 12  # bits of the order-2 and order-1 tables' addresses
_SCRAMBLE = np.uint32(0x9E3779B1)
_T = 1 << 16  # probabilities and frequencies are parts of this
_KINDS = _T >> 2  # ids with a frequency of their own in a block
_LEAST = float(1 << 32)  # a coder's range stays from here to 2**48
_STATES = 128  # confidence of order 2 (8), of order 1 (8), same candidate (2)

_COST = np.array([12 * 256] + [round(-math.log2(i / 4096) * 256) for i in range(1, 4097)], np.int64)  # 1/256 bits, of p * 4096
_WEIGHT = np.array([round(65536 * 2 ** (-i / 4)) for i in range(64)] + [0], np.int64)


class _Writer:
    """Range encoders, one a lane. A digit keeps its carry until the end."""

    def __init__(self, lanes: int, steps: int) -> None:
        self.low, self.range = np.zeros(lanes), np.full(lanes, float(1 << 48))
        self.out, self.at = np.zeros((lanes, steps + 64), np.int32), np.zeros(lanes, np.int64)
        self.rows = np.arange(lanes) * self.out.shape[1]

    def reserve(self, more: int) -> None:
        """Makes room for so many digits of each lane."""
        need = int(self.at.max()) + more
        if need > self.out.shape[1]:
            self.out = np.pad(self.out, ((0, 0), (0, need)))
            self.rows = np.arange(len(self.low)) * self.out.shape[1]

    def renew(self) -> None:
        small = self.range < _LEAST
        while small.any():
            digit = np.floor(self.low * 2.0**-32)
            self.out.reshape(-1)[self.rows + self.at] = digit  # where the range is large, the next digit takes this one's place
            self.at += small
            more = small.astype(np.float64)
            self.low -= digit * (more * 2.0**32)
            more *= 65535.0
            more += 1.0
            self.low *= more
            self.range *= more
            small = self.range < _LEAST

    def close(self) -> list[np.ndarray]:
        """Each lane's digits; those after the last are zeros."""
        self.reserve(1)
        self.out.reshape(-1)[self.rows + self.at] = np.ceil(self.low * 2.0**-32)
        self.at += 1
        out = self.out
        while (carry := out >> 16).any():  # no lane's first digit has one, nor what stands after its last
            out &= 0xFFFF
            out[:, :-1] += carry[:, 1:]
        out = out.astype(">u2")
        return [row[:n] for row, n in zip(out, self.at.tolist())]


class _Reader:
    """Range decoders, one a lane."""

    def __init__(self, lanes: list[np.ndarray]) -> None:
        at = np.cumsum([0] + [len(d) + 4 for d in lanes])
        self.digits = np.zeros(at[-1])
        for a, d in zip(at.tolist(), lanes):
            self.digits[a : a + len(d)] = d
        at = at[:-1]
        self.code = (self.digits[at] * 65536.0 + self.digits[at + 1]) * 65536.0 + self.digits[at + 2]
        self.range, self.at = np.full(len(lanes), float(1 << 48)), at + 3

    def renew(self) -> None:
        small = self.range < _LEAST
        while small.any():
            more = small.astype(np.float64)
            digit = self.digits.take(self.at, mode="clip")
            digit *= more
            more *= 65535.0
            more += 1.0
            self.code *= more
            self.code += digit
            self.range *= more
            self.at += small
            small = self.range < _LEAST


class _Outcomes:
    """Probabilities of the three outcomes in every state of every block."""

    def __init__(self, blocks: int) -> None:
        self.counts = np.zeros((blocks, 8, 8, 2, 3), np.int64)
        self.spent = np.zeros((blocks, 4), np.int64)
        self.predictions = self._predict()
        self._mix()

    def _predict(self) -> list[np.ndarray]:
        c = self.counts
        sums = [c, c.sum(axis=2, keepdims=True), c.sum(axis=1, keepdims=True), c.sum(axis=(1, 2), keepdims=True)]
        return [np.broadcast_to((2 * s + 1) / (2 * s.sum(axis=-1, keepdims=True) + 3), c.shape) for s in sums]

    def _mix(self) -> None:
        weight = _WEIGHT[np.minimum((self.spent - self.spent.min(axis=1, keepdims=True)) >> 10, 64)].astype(np.float64)[:, :, None, None, None, None]
        w = [weight[:, k] for k in range(4)]
        a, b, c, d = self.predictions
        p = (w[0] * a + w[1] * b + w[2] * c + w[3] * d) / (w[0] + w[1] + w[2] + w[3])
        first = np.clip(np.floor(p[..., 0] * _T), 16, _T - 4096)
        second = np.minimum(first + np.clip(np.floor(p[..., 1] * _T), 16, _T), _T - 1024)
        flat = lambda *x: np.stack(x, axis=-1).reshape(-1)
        self.low, self.size = flat(np.zeros_like(first), first, second, second), flat(first, second - first, _T - second, second)

    def learn(self, seen: np.ndarray) -> None:
        """seen: (block * _STATES + state) * 4 + outcome of the ids since the last call."""
        new = np.bincount(seen, minlength=self.counts.size // 3 * 4).reshape(*self.counts.shape[:-1], 4)[..., :3]
        self.spent >>= 1  # older evidence fades
        for k, p in enumerate(self.predictions):
            self.spent[:, k] += (new * _COST[np.floor(p * 4096).astype(np.int64)]).sum(axis=(1, 2, 3, 4))
        self.counts += new
        self.predictions = self._predict()
        self._mix()


class _Frequencies:
    """Order 0 of every block: slots (start, size) of ids; place 0 stands for "all", a block's last place for its escape."""

    def __init__(self, blocks: int, bits: int, encode: bool) -> None:
        self.room, self.ids = _KINDS + 1, 1 << bits
        self.escape = np.arange(1, blocks + 1) * self.room
        self.start, self.size, self.id = np.zeros(blocks * self.room + 1), np.zeros(blocks * self.room + 1), np.zeros(blocks * self.room + 1, np.int32)
        self.size[0] = _T
        self.size[self.escape] = _T
        self.counts = np.zeros((blocks, self.ids), np.int64)
        # the place of an id (to encode), or of a part of the range (to decode)
        self.place = np.repeat(self.escape, self.ids if encode else _T).astype(np.int32)
        self.encode = encode

    def learn(self, block: int, ids: np.ndarray, escapes: int) -> None:
        """ids coded by order 0 since the last call, and how many of them by the escape."""
        counts = self.counts[block]
        counts += np.bincount(ids, minlength=self.ids)
        met = np.flatnonzero(counts)
        if not len(met):
            return
        if len(met) > _KINDS:
            if self.encode:
                self.place[block * self.ids + met] = self.escape[block]
            met = np.sort(met[np.argsort(-counts[met], kind="stable")[:_KINDS]])
        n = counts[met]
        escape = min(max(_T * (escapes + 1) // (len(ids) + 2), 16), _T >> 1)
        size = 1 + n * (_T - escape - len(met)) // n.sum()
        end = np.cumsum(size)
        first = block * self.room + 1
        k = slice(first, first + len(met))
        self.start[k], self.size[k], self.id[k] = end - size, size, met
        self.start[self.escape[block]], self.size[self.escape[block]] = end[-1], _T - end[-1]
        if self.encode:
            self.place[block * self.ids + met] = np.arange(first, first + len(met))
        else:
            own = self.place[block * _T : (block + 1) * _T]
            own[: end[-1]] = np.repeat(np.arange(first, first + len(met), dtype=np.int32), size)
            own[end[-1] :] = self.escape[block]


def _code(coder: _Writer | _Reader, lanes: list[int], steps: int, bits: int, ids: np.ndarray | None) -> np.ndarray:
    """Runs all blocks (given by their numbers of lanes) side by side. ids (step by lane) are encoded; without them they are decoded and returned."""
    encode, blocks, width = ids is not None, len(lanes), sum(lanes)
    got = ids if encode else np.zeros((steps, width), np.int32)
    mixed = np.zeros((steps + 2, width), np.uint32)  # ids scrambled, two steps late
    if encode:
        np.multiply(got.view(np.uint32), _SCRAMBLE, out=mixed[2:])
    block, cuts = np.repeat(np.arange(blocks), lanes), np.cumsum([0, *lanes]).tolist()
    two, one = np.zeros(blocks << _TWO, np.int32), np.zeros(blocks << _ONE, np.int32)
    base2, base1, base_state = block << _TWO, block << _ONE, block * (4 * _STATES)
    outcomes, order0 = _Outcomes(blocks), _Frequencies(blocks, bits, encode)
    base0, escape = block * (order0.ids if encode else _T), order0.escape[block]
    seen, missed, escaped = np.zeros(got.shape, np.int32), np.zeros(got.shape, bool), np.zeros(got.shape, bool)

    def entries(before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """Addresses and entries of both tables, and the state that they make."""
        at2 = ((last + (before << np.uint32(7)) + (before >> np.uint32(9))) >> np.uint32(32 - _TWO)) + base2
        at1 = (last >> np.uint32(32 - _ONE)) + base1
        e2, e1 = two.take(at2, mode="clip"), one.take(at1, mode="clip")
        return at2, at1, e2, e1, (((e2 & 7) << 6) + ((e1 & 7) << 3) + (((e2 ^ e1) < 8) << np.int32(2))) + base_state

    def escapes(t: int, place: np.ndarray, x: np.ndarray) -> None:
        """Plain bits of the ids that order 0 hasn't met."""
        new = np.equal(place, escape, out=escaped[t])
        if not new.any():
            return
        lane = np.flatnonzero(new)
        part = np.floor(coder.range[lane] * 2.0**-bits)
        if encode:
            coder.low[lane] += x[lane] * part
        else:
            value = np.minimum(np.floor(coder.code[lane] / part), (1 << bits) - 1)
            coder.code[lane] -= value * part
            x[lane] = value
        coder.range[lane] = part
        coder.renew()

    start = renewed = 0
    for stop in [n for n in _SPANS if n < steps] + [steps]:
        span = slice(start, stop)
        if encode:  # all but the coders' arithmetic in one go
            x = got[span]
            at2, at1, e2, e1, state = entries(mixed[span], mixed[start + 1 : stop + 1])
            x8 = x << 3
            right2, right1 = ((e2 ^ x8) - 8) >> 31, ((e1 ^ x8) - 8) >> 31  # -1 or 0
            miss = ~(right2 | right1)
            state += 2 + 2 * right2 + (right1 & ~right2)
            place = order0.place.take(base0 + x, mode="clip") & miss
            low, first, size = outcomes.low.take(state, mode="clip"), order0.start.take(place, mode="clip"), order0.size.take(place, mode="clip")
            whole = outcomes.size.take(state, mode="clip")
            seen[span], missed[span] = state, miss
            coder.reserve(4 * (stop - start) + 8)
            for i in range(stop - start):
                part = np.floor(coder.range * 2.0**-16)
                coder.low += low[i] * part
                part *= whole[i]
                part *= 2.0**-16
                np.floor(part, out=part)
                coder.low += first[i] * part
                part *= size[i]
                coder.range = part
                coder.renew()
                escapes(start + i, place[i], x[i])
        else:
            kept = []
            for t in range(start, stop):
                at2, at1, e2, e1, state = entries(mixed[t], mixed[t + 1])
                kept.append((at2, at1, e2, e1))
                part = np.floor(coder.range * 2.0**-16)
                target = np.floor(coder.code / part)
                not2, miss = target >= outcomes.size.take(state, mode="clip"), target >= outcomes.size.take(state + 3, mode="clip")
                state += not2
                state += miss
                coder.code -= outcomes.low.take(state, mode="clip") * part
                part *= outcomes.size.take(state, mode="clip")
                part *= 2.0**-16
                np.floor(part, out=part)
                slot = (coder.code / part).astype(np.int64)
                slot += base0
                not2, off = -not2.astype(np.int32), -miss.astype(np.int32)
                place = order0.place.take(slot, mode="clip") & off
                coder.code -= order0.start.take(place, mode="clip") * part
                part *= order0.size.take(place, mode="clip")
                coder.range = part
                coder.renew()
                x = (e2 ^ ((e2 ^ e1) & not2)) >> 3
                x ^= (x ^ order0.id.take(place, mode="clip")) & off
                escapes(t, place, x)
                got[t], missed[t], seen[t] = x, miss, state
                np.multiply(x.view(np.uint32), _SCRAMBLE, out=mixed[t + 2])
            x8 = got[span] << 3
            at2, at1, e2, e1 = (np.stack(k) for k in zip(*kept))
            right2, right1 = ((e2 ^ x8) - 8) >> 31, ((e1 ^ x8) - 8) >> 31
        for table, at, entry, right in ((two, at2, e2, right2), (one, at1, e1, right1)):
            sure = entry & 7
            few = (sure - 2) >> 31  # -1 where the entry gives way if it was wrong
            down, up = (sure >> 1) - few, sure + 1 - ((sure + 1) >> 3)
            entry = entry ^ ((entry ^ x8) & few)
            table[at] = (entry & -8) | (down ^ ((down ^ up) & right))  # of equal addresses the last one stays
        if stop in _RENEWALS and stop < steps:
            outcomes.learn(seen[renewed:stop].reshape(-1))
            for b in range(blocks):
                own = (slice(renewed, stop), slice(cuts[b], cuts[b + 1]))
                order0.learn(b, got[own][missed[own]], int(np.count_nonzero(escaped[own])))
            renewed = stop
        start = stop
    return got


def _lanes(n: int) -> int:
    return max(1, -(-n // STEPS))


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each array of at most 65,535 * STEPS ids below MAX_ID as one block. The last lane is padded while coding; zeros that repeat cost next to nothing."""
    if not blocks:
        return []
    for b in blocks:
        if len(b) and not 0 <= int(b.min()) <= int(b.max()) < MAX_ID:
            raise ValueError(f"ids must be from 0 to {MAX_ID - 1}")
    bits = max(16, max(int(b.max(initial=0)) for b in blocks).bit_length())
    steps, lanes = min(STEPS, max(map(len, blocks))), [_lanes(len(b)) for b in blocks]
    ids = np.zeros((sum(lanes), steps), np.int32)
    at = 0
    for b, k in zip(blocks, lanes):
        ids[at : at + k].reshape(-1)[: len(b)] = b
        at += k
    coder = _Writer(len(ids), steps)
    _code(coder, lanes, steps, bits, np.ascontiguousarray(ids.T))
    digits, out = iter(coder.close()), []
    for b, k in zip(blocks, lanes):
        own = [next(digits) for _ in range(k)]
        sizes = np.array([len(d) for d in own], ">u2")
        out.append(b"".join([HEAD.pack(MAGIC, len(b), bits, zlib.crc32(b.astype("<u4").tobytes())), sizes.tobytes(), *(d.tobytes() for d in own)]))
    return out


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ValueError where a block is damaged."""
    if not blocks:
        return []
    heads = [HEAD.unpack_from(b) if len(b) >= HEAD.size and b[:4] == MAGIC else None for b in blocks]
    if any(h is None or not 16 <= h[2] <= 18 for h in heads):
        raise ValueError("not a block")
    out: list[np.ndarray | None] = [None] * len(blocks)
    for bits in {h[2] for h in heads}:
        own = [i for i, h in enumerate(heads) if h[2] == bits]
        lanes, digits = [_lanes(heads[i][1]) for i in own], []
        for i, k in zip(own, lanes):
            at = HEAD.size + 2 * k
            sizes = np.frombuffer(blocks[i][HEAD.size : at], ">u2")
            if len(sizes) != k or at + 2 * int(sizes.sum()) != len(blocks[i]):
                raise ValueError("a block's length differs")
            digits += np.split(np.frombuffer(blocks[i][at:], ">u2"), np.cumsum(sizes)[:-1])
        steps = min(STEPS, max(heads[i][1] for i in own))
        got, at = _code(_Reader(digits), lanes, steps, bits, None), 0
        for i, k in zip(own, lanes):
            out[i] = np.ascontiguousarray(got[:, at : at + k].T).reshape(-1)[: heads[i][1]].astype("<u4")
            at += k
            if len(out[i]) != heads[i][1] or zlib.crc32(out[i].tobytes()) != heads[i][3]:
                raise ValueError("a block's checksum differs")
    return out
