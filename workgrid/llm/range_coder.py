"""Adaptive context-mixing range coder for token ids, over many blocks at once.

A block is coded on its own: all statistics start empty. Every id is first
offered to two predictors, the id that last followed the two ids before it
(order 2) and the id that last followed the one before it (order 1). Each
predictor has adaptive probabilities of "order 2 is right", "order 1 is
right" and "neither" by its confidence; the two are mixed with an adaptive
weight. An id that neither predicts is coded by adaptive order-0 frequencies
of recent ids, and an id that is not among these as 16 plain bits after an
escape.

The coder is a range coder with a 48-bit interval and 16-bit digits; carries
are resolved once per block at its end. Blocks are lanes of NumPy arrays that
take one step per id together, so the Python overhead of a step is shared by
all lanes.

A coded block is ``MAGIC, n, crc32, digits``: little-endian unsigned 32-bit
integers (crc32 of the ids as little-endian unsigned 32-bit integers), then
the digits as little-endian unsigned 16-bit integers.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"WGR1"
LANES = 1024
MAX_ID = (1 << 16) - 1

_HEAD = struct.Struct("<4sIII")
_P = 12  # bits of a mixed probability
_ONE = 1 << _P
_RATE = 5
_W = 8
_SLOT2, _SLOT1, _SLOT0 = 11, 11, 11
_SLOTS = 1 << _SLOT0
_ESCAPE = _SLOTS
_BOTTOM = 1 << 32
_MASK32 = _BOTTOM - 1
_GAIN = 24  # weight of one occurrence in the order-0 frequencies
_CEILING = 1 << 15


def _rebuild_at(step: int) -> bool:
    """Steps at which the cumulative order-0 frequencies are renewed."""
    return step % 128 == 0 or step in (8, 16, 32, 64)


class _Model:
    """Adaptive state of all lanes, the same in the encoder and the decoder."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        lane = np.arange(lanes, dtype=np.int64)
        # Rows of two: order 2 and order 1, side by side so that a step handles both at once.
        self.base = np.stack([lane << _SLOT2, (lanes << _SLOT2) + (lane << _SLOT1)])
        self.base0 = lane << _SLOT0
        self.base_cum = lane * (_SLOTS + 2)
        # Predicted id in the low 16 bits, confidence 0 to 3 above; confidence 0 without a prediction.
        self.next = np.zeros((lanes << _SLOT2) + (lanes << _SLOT1), np.int32)
        # Probabilities of the first two outcomes (two 32-bit halves of a cell), by confidence and agreement.
        self.prob = np.full((2 * lanes * 8, 2), _ONE // 4, np.int32).view(np.int64).reshape(-1)
        self.base_p = np.stack([lane * 8, (lanes + lane) * 8])
        self.weight = np.full((lanes, 1), 1 << (_W - 1), np.int32)
        self.owner = np.full(lanes << _SLOT0, -1, np.int32)
        self.count = np.zeros((lanes, _SLOTS + 1), np.int32)
        self.count[:, _ESCAPE] = _GAIN
        self.cum = np.zeros((lanes, _SLOTS + 2), np.int32)
        self.rebuild()
        self.last1 = np.zeros(lanes, np.int64)
        self.last2 = np.zeros(lanes, np.int64)

    def rebuild(self) -> None:
        np.cumsum(self.count, axis=1, dtype=np.int32, out=self.cum[:, 1:])
        full = self.cum[:, -1] > _CEILING
        if full.any():
            self.count[full] = (self.count[full] + 1) >> 1
            np.cumsum(self.count[full], axis=1, dtype=np.int32, out=(renewed := np.empty((int(full.sum()), _SLOTS + 1), np.int32)))
            self.cum[full, 1:] = renewed

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the first ``n`` lanes: predicted ids of order 2 and 1, frequencies of the first two outcomes."""
        a, b = self.last1[:n], self.last2[:n]
        a = a * 40503
        self.at = np.empty((2, n), np.int64)
        np.add(self.base[0, :n], (a + b * 30011 >> 3) & ((1 << _SLOT2) - 1), out=self.at[0])
        np.add(self.base[1, :n], (a >> 4) & ((1 << _SLOT1) - 1), out=self.at[1])
        v = self.v = self.next.take(self.at)
        c = self.c = v & MAX_ID
        self.sure = v >> 16
        agree = (c[0] == c[1]).view(np.int8) << 2
        self.p = self.base_p[:, :n] + (self.sure + agree)
        f = self.f = self.prob.take(self.p).view(np.int32).reshape(2, n, 2)
        self.lead = f[0] - f[1]
        mixed = f[1] + (self.lead * self.weight[:n] >> _W)
        return c[0], c[1], mixed[:, 0].astype(np.int64), mixed[:, 1].astype(np.int64)

    def update(self, n: int, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        # The weight moves to the order that gave the outcome the higher probability.
        lead0, lead1 = self.lead[:, 0], self.lead[:, 1]
        lead = np.where(hit2, lead0, np.where(hit1, lead1, -(lead0 + lead1)))
        w = self.weight[:n, 0]
        w += np.sign(lead) << 1
        np.minimum(np.maximum(w, 8, out=w), (1 << _W) - 8, out=w)
        room = _ONE - 64  # both stay above 16 and leave 16 for "neither"
        goal = np.empty((n, 2), np.int32)
        np.multiply(hit2, room, out=goal[:, 0], casting="unsafe")
        np.multiply(hit1, room, out=goal[:, 1], casting="unsafe")
        f = goal - self.f
        f >>= _RATE
        f += self.f
        np.maximum(f, 16, out=f)
        self.prob[self.p] = f.view(np.int64).reshape(2, n)
        new = ids.astype(np.int32)
        right = (self.c == new) & (self.sure > 0)
        # A wrong prediction loses confidence before it is replaced.
        weak = self.sure <= 1
        self.next[self.at] = np.where(right, new | (np.minimum(self.sure + 1, 3) << 16), np.where(weak, new | (1 << 16), self.v - (1 << 16)))
        self.last2[:n] = self.last1[:n]
        self.last1[:n] = ids

    def slots(self, ids: np.ndarray) -> np.ndarray:
        return (ids * 40503 >> 5) & (_SLOTS - 1)

    def note(self, lanes: np.ndarray, ids: np.ndarray, slot: np.ndarray, known: np.ndarray) -> None:
        """Order-0 frequencies after an id that both predictors missed."""
        flat = self.count.reshape(-1)
        base = lanes * (_SLOTS + 1)
        at = base + slot
        flat[at] = np.where(known, flat[at] + _GAIN, _GAIN)
        new = ~known
        flat[base[new] + _ESCAPE] += _GAIN >> 1
        self.owner[self.base0[lanes[new]] + slot[new]] = ids[new]


class _Writer:
    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, 1 << 48, np.int64)
        self.digits = np.zeros((lanes, 2 * steps + 8), np.int32)
        self.used = np.zeros(lanes, np.int64)

    def put(self, lanes, start, size, unit) -> None:
        """Narrow the lanes to ``start .. start + size`` of ``range / unit`` parts; ``unit`` is the width of one part."""
        low = self.low[lanes] + unit * start
        width = unit * size
        short = np.flatnonzero(width < _BOTTOM)
        if short.size:
            at = short if isinstance(lanes, slice) else lanes[short]
            part = low[short]
            used = self.used[at]
            self.digits[at, used] = part >> 32  # may hold a carry
            self.used[at] = used + 1
            low[short] = (part & _MASK32) << 16
            width[short] <<= 16
        self.low[lanes] = low
        self.range[lanes] = width

    def finish(self) -> list[np.ndarray]:
        for _ in range(3):
            at = np.arange(self.low.size)
            self.digits[at, self.used] = self.low >> 32
            self.used += 1
            self.low = (self.low & _MASK32) << 16
        carry = np.zeros(self.low.size, np.int32)
        for k in range(int(self.used.max()) - 1, -1, -1):
            total = self.digits[:, k] + carry
            self.digits[:, k] = total & MAX_ID
            carry = total >> 16
        return [d[:n].astype("<u2") for d, n in zip(self.digits, self.used)]


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Coded bytes of every block of ids (0 to 65535), at most ``LANES`` blocks of at least one id each."""
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i].size)
    sizes = np.array([blocks[i].size for i in order])
    lanes, steps = len(blocks), int(sizes[0])
    ids = np.zeros((steps, lanes), np.int64)
    for k, i in enumerate(order):
        ids[: blocks[i].size, k] = blocks[i]
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    model, out = _Model(lanes), _Writer(lanes, steps)
    cum = model.cum.reshape(-1)
    for t in range(steps):
        n = int(active[t])
        now = ids[t, :n]
        c2, c1, first, second = model.predict(n)
        hit2 = now == c2
        hit1 = (now == c1) & ~hit2
        miss = ~(hit2 | hit1)
        start = np.where(hit2, 0, np.where(hit1, first, first + second))
        size = np.where(hit2, first, np.where(hit1, second, _ONE - first - second))
        out.put(slice(0, n), start, size, out.range[:n] >> _P)
        model.update(n, now, hit2, hit1)
        left = np.flatnonzero(miss)
        if left.size:
            some = now[left]
            slot = model.slots(some)
            known = model.owner.take(model.base0[left] + slot) == some
            symbol = np.where(known, slot, _ESCAPE)
            at = model.base_cum[left] + symbol
            begin = cum.take(at)
            size = cum.take(at + 1) - begin
            # A slot that is newer than the frequencies has no share yet: escape.
            known &= size > 0
            fix = np.flatnonzero(size == 0)
            if fix.size:
                at = model.base_cum[left[fix]] + _ESCAPE
                begin[fix] = cum.take(at)
                size[fix] = cum.take(at + 1) - begin[fix]
            out.put(left, begin, size, out.range[left] // cum.take(model.base_cum[left] + _SLOTS + 1))
            new = np.flatnonzero(~known)
            if new.size:
                far = left[new]
                out.put(far, some[new], 1, out.range[far] >> 16)
            model.note(left, some, slot, known)
        if _rebuild_at(t + 1):
            model.rebuild()
    coded: list[bytes] = [b""] * lanes
    for k, digits in enumerate(out.finish()):
        block = blocks[order[k]]
        crc = zlib.crc32(block.astype("<u4").tobytes())
        coded[order[k]] = _HEAD.pack(MAGIC, block.size, crc, digits.size) + digits.tobytes()
    return coded


def decode(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of every coded block, as unsigned 32-bit integers; raises ValueError on a damaged block."""
    heads = [_HEAD.unpack_from(c) if len(c) >= _HEAD.size else (b"", 0, 0, 0) for c in coded]
    for c, (magic, n, _, digits) in zip(coded, heads):
        if magic != MAGIC or n < 1 or len(c) != _HEAD.size + 2 * digits:
            raise ValueError("not a coded block")
    order = sorted(range(len(coded)), key=lambda i: -heads[i][1])
    sizes = np.array([heads[i][1] for i in order])
    lanes, steps = len(coded), int(sizes[0])
    width = max(h[3] for h in heads) + 4
    digits = np.zeros((lanes, width), np.int64)
    for k, i in enumerate(order):
        digits[k, : heads[i][3]] = np.frombuffer(coded[i], "<u2", offset=_HEAD.size)
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    code = digits[:, 0] << 32 | digits[:, 1] << 16 | digits[:, 2]
    span = np.full(lanes, 1 << 48, np.int64)
    used = np.full(lanes, 3, np.int64)
    flat_digits, row = digits.reshape(-1), np.arange(lanes, dtype=np.int64) * width
    model = _Model(lanes)
    cum = model.cum.reshape(-1)
    ids = np.zeros((steps, lanes), np.int64)

    def take(at, start, left) -> None:
        """Leave the part of width ``left`` from ``start``."""
        value = code[at] - start
        short = np.flatnonzero(left < _BOTTOM)
        if short.size:
            who = short if isinstance(at, slice) else at[short]
            where = used[who]
            value[short] = value[short] << 16 | flat_digits.take(row[who] + np.minimum(where, width - 1))
            used[who] = where + 1
            left[short] <<= 16
        code[at] = value
        span[at] = left

    for t in range(steps):
        n = int(active[t])
        c2, c1, first, second = model.predict(n)
        unit = span[:n] >> _P
        some, all_ = unit * first, unit * (first + second)
        value = code[:n]
        hit2 = value < some
        miss = value >= all_
        hit1 = ~(hit2 | miss)
        begin = np.where(hit2, 0, np.where(hit1, some, all_))
        take(slice(0, n), begin, np.where(hit2, some, np.where(hit1, all_, unit << _P)) - begin)
        now = np.where(hit2, c2, c1).astype(np.int64)
        left = np.flatnonzero(miss)
        if left.size:
            base = model.base_cum[left]
            unit = span[left] // cum.take(base + _SLOTS + 1)
            target = (code[left] // unit).astype(np.int32)
            # Largest symbol whose cumulative frequency is not above the target.
            at, escape = base, base + _ESCAPE
            step = _SLOTS >> 1
            while step:
                up = at + step
                at = np.where(cum.take(up) <= target, up, at)
                step >>= 1
            at = np.where(cum.take(escape) <= target, escape, at)
            begin = cum.take(at)
            symbol = at - base
            take(left, unit * begin, unit * (cum.take(at + 1) - begin))
            known = symbol != _ESCAPE
            some = model.owner.take(model.base0[left] + np.minimum(symbol, _SLOTS - 1)).astype(np.int64)
            new = np.flatnonzero(~known)
            if new.size:
                far = left[new]
                unit = span[far] >> 16
                some[new] = np.minimum(code[far] // unit, MAX_ID)
                take(far, unit * some[new], unit)
            now[left] = some
            hits = (hit2, hit1)
            model.update(n, now, *hits)
            model.note(left, some, model.slots(some), known)
        else:
            model.update(n, now, hit2, hit1)
        ids[t, :n] = now
        if _rebuild_at(t + 1):
            model.rebuild()
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * lanes
    for k, i in enumerate(order):
        block = ids[: sizes[k], k].astype("<u4")
        if zlib.crc32(block.tobytes()) != heads[i][2]:
            raise ValueError("checksum of a block does not match")
        out[i] = block
    return out
