"""Adaptive context-mixing range coder for token ids, vectorised over independent blocks.

A frame is cut into blocks of equal length, about BLOCK ids, each with a checksum; all that adapts is reset from block to
block, so a block can be decoded with the frame's head alone. The head holds the order-0 prediction: how often each id occurs
in the frame. Inside a block the last two ids (order 2) and the last one (order 1) each predict an id. The probability that
order 2 is right is mixed in the logistic domain from its own confidence, that of order 1, and the order-0 probability of the
id, with weights learned while coding; then comes order 1's own id, and what neither foresaw is coded by order 0. All
arithmetic is on integers, so that a decoder repeats it exactly. Blocks are coded side by side, one id of each at a time.
"""

from __future__ import annotations

import math
import struct
import zlib
from zlib import crc32

import numpy as np

#: Ids in a block, about.
BLOCK = 2048
MAGIC = b"CMRC\x02"
#: Ids in all, blocks, ids in a block, distinct ids, bits of the order-0 scale, bytes of the packed head.
HEAD = struct.Struct("<QIIIII")
#: Bytes of a block's stream and its checksum.
ENTRY = struct.Struct("<II")
#: Slots of the tables of order 2 and order 1, for each block.
SLOTS2, SLOTS1 = 1 << 11, 1 << 11
U = np.uint64
HALF = U(32)
LEAST = U(1 << 32)
#: Distinct ids that a frame can hold: each needs a share of the order-0 scale, which is 20 bits at most.
MOST_DISTINCT = 1 << 19


def _logistic() -> tuple[np.ndarray, np.ndarray]:
    """stretch: ln(p / (1 - p)) in 1/256 by 12-bit probability; squash: its inverse over -2047..2047."""
    squash = np.array([min(4094, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], np.int64)
    stretch = np.array([min(2047, max(-2047, round(256 * math.log((p + 0.5) / (4095.5 - p))))) for p in range(4096)], np.int64)
    return stretch, squash


STRETCH, SQUASH = _logistic()
#: Starting chances, of 4096, of a prediction that was right 0 to 7 times in a row (twice each: alone, and where both orders agree).
CHANCE = np.repeat(np.array([200, 400, 1200, 1800, 2400, 2800, 3200, 3600], np.int64), 2)
SURE = STRETCH[CHANCE]


class _Order0:
    """The frame's counts as whole shares of 2^bits, each at least 1."""

    def __init__(self, shares: np.ndarray, bits: int):
        self.bits, self.shares = bits, shares.astype(U)
        ends = np.cumsum(shares)
        self.starts = (ends - shares).astype(U)
        # by whole bits, so that every machine has the same table
        self.stretch = np.array([round(177.45 * (int(s).bit_length() - 1 - bits)) for s in shares], np.int64)

    @classmethod
    def of(cls, counts: np.ndarray) -> _Order0:
        bits = min(20, max(16, int(len(counts) - 1).bit_length() + 3))
        total, free = int(counts.sum()), (1 << bits) - len(counts)
        shares = 1 + counts * free // total
        shares[int(counts.argmax())] += (1 << bits) - int(shares.sum())
        return cls(shares, bits)


class _Model:
    """Predictions of all blocks; one id of each block at a time."""

    def __init__(self, blocks: int, order0: _Order0):
        lanes, names = np.arange(blocks, dtype=np.int64), np.arange(len(order0.shares), dtype=np.int64)
        self.chance0 = order0.stretch
        self.hash1 = (names * 40503 >> 3) & (SLOTS1 - 1)
        self.hash2, self.hash2b = (names * 2654435761 >> 7) & (SLOTS2 - 1), (names * 2246822519 >> 11) & (SLOTS2 - 1)
        self.at1, self.at2 = lanes * SLOTS1, lanes * SLOTS2
        self.t1, self.t2 = np.zeros(blocks * SLOTS1, np.int32), np.zeros(blocks * SLOTS2, np.int32)
        self.lane = lanes * 16
        self.q1 = np.tile(np.where(np.arange(16) & 1, 0, CHANCE >> 1), blocks)
        self.w2, self.w1, self.w0 = (np.full(blocks, w, np.int64) for w in (50000, 20000, 4000))
        self.i1, self.i2, self.last = self.at1, self.at2, np.zeros(blocks, np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """The widths, of 4096, of what order 2 and order 1 predict."""
        self.e2, self.e1 = self.t2.take(self.i2).astype(np.int64), self.t1.take(self.i1).astype(np.int64)
        self.p2, self.p1 = self.e2 >> 4, self.e1 >> 4
        same = self.p1 == self.p2
        state1 = (self.e1 & 14) + same
        self.j1 = self.lane + state1
        self.vb = self.q1.take(self.j1)
        self.s2, self.s1, self.s0 = SURE.take((self.e2 & 14) + same), SURE.take(state1), self.chance0.take(self.p2)
        z = (self.w2 * self.s2 + self.w1 * self.s1 + self.w0 * self.s0) >> 16
        self.a = SQUASH.take(z + 2047, mode="clip")
        return self.a, ((4096 - self.a) * self.vb) >> 12

    def update(self, x: np.ndarray, ok2: np.ndarray, ok1: np.ndarray) -> None:
        error = ok2 * np.int64(4095) - self.a
        self.w2 += (self.s2 * error) >> 9
        self.w1 += (self.s1 * error) >> 9
        self.w0 += (self.s0 * error) >> 10
        self.q1[self.j1] = np.where(ok2, self.vb, self.vb + ((ok1 * np.int64(4095) - self.vb) >> 5))
        fresh = (x << 4) | 2
        self.t2[self.i2] = np.where(ok2, np.minimum(self.e2 + 2, self.e2 | 14), fresh).astype(np.int32)
        self.t1[self.i1] = np.where(ok1, np.minimum(self.e1 + 2, self.e1 | 14), fresh).astype(np.int32)
        self.i1 = self.at1 + self.hash1.take(x)
        self.i2 = self.at2 + (self.hash2.take(x) ^ self.last)
        self.last = self.hash2b.take(x)


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids, each id's place among them, and their counts."""
    if int(ids.max()) < 1 << 24:
        counts = np.bincount(ids)
        used = np.flatnonzero(counts)
        place = np.zeros(len(counts), np.int32)
        place[used] = np.arange(len(used))
        return used, place.take(ids), counts[used]
    return np.unique(ids, return_inverse=True, return_counts=True)


def encode(ids: np.ndarray) -> bytes:
    """A frame of ids (0 to 2^32 - 1): magic, head, a table of the blocks, then each block's stream. ValueError beyond MOST_DISTINCT ids."""
    if not len(ids):
        return MAGIC + HEAD.pack(0, 0, 0, 0, 0, 0)
    used, local, counts = _numbered(np.ascontiguousarray(ids))
    if len(used) > MOST_DISTINCT:
        raise ValueError(f"more than {MOST_DISTINCT} distinct ids in a frame")
    order0 = _Order0.of(counts)
    blocks = -(-len(ids) // BLOCK)
    length = -(-len(ids) // blocks)
    columns = np.ascontiguousarray(np.concatenate([local, np.full(blocks * length - len(ids), local[-1], local.dtype)]).reshape(blocks, length).T)
    del local
    model = _Model(blocks, order0)
    low, width = np.zeros(blocks, U), np.full(blocks, 0xFFFFFFFFFFFFFFFF, U)
    room = length + 4  # an id takes at most one digit of 32 bits
    digits, pos = np.zeros(blocks * room, np.uint32), np.arange(blocks, dtype=np.int64) * room + 1
    carries: list[np.ndarray] = []
    shift0 = U(order0.bits)
    for column in columns:
        x = column.astype(np.int64)
        a, b = model.predict()
        ok2, ok1 = model.p2 == x, model.p1 == x
        unit = width >> U(12)
        first = unit * a.view(U)
        both = unit * (a + b).view(U)
        rest = ((unit << U(12)) - both) >> shift0
        hit1 = ok1 & (b > 0)
        start = np.where(ok2, U(0), np.where(hit1, first, both + rest * order0.starts.take(x)))
        width = np.where(ok2, first, np.where(hit1, both - first, rest * order0.shares.take(x)))
        low += start
        over = low < start
        if over.any():
            carries.append(pos[over] - 1)
        go = np.flatnonzero(width < LEAST)
        if len(go):
            at, moved = pos[go], low[go]
            digits[at] = moved >> HALF
            pos[go] = at + 1
            low[go] = moved << HALF
            width[go] <<= HALF
        model.update(x, ok2, ok1)
    for shift in (32, 0):
        digits[pos] = (low >> U(shift)).astype(np.uint32)
        pos += 1
    if carries:  # into the digits before; rarely on from there
        up = np.concatenate(carries)
        while len(up):
            up, n = np.unique(up, return_counts=True)
            total = digits[up].astype(np.int64) + n
            digits[up] = total & 0xFFFFFFFF
            up = up[total >> 32 > 0] - 1
    head = zlib.compress(np.diff(used, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() + order0.shares.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
    raw, table, body = ids.astype("<u4", copy=False), [], []
    for i in range(blocks):
        stream = digits[i * room + 1 : pos[i]].astype("<u4").tobytes()
        table.append(ENTRY.pack(len(stream), crc32(raw[i * length : (i + 1) * length].tobytes())))
        body.append(stream)
    return b"".join([MAGIC, HEAD.pack(len(ids), blocks, length, len(used), order0.bits, len(head)), head, *table, *body])


def decode(frame: bytes) -> np.ndarray:
    """The ids of a frame; ValueError where it, or a block's checksum, is wrong."""
    if frame[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token frame")
    n, blocks, length, distinct, bits, packed = HEAD.unpack_from(frame, len(MAGIC))
    if not n:
        return np.zeros(0, np.int64)
    at = len(MAGIC) + HEAD.size
    try:
        head = zlib.decompress(frame[at : at + packed])
    except zlib.error as e:
        raise ValueError("the frame's head is damaged") from e
    gaps, shares = (np.frombuffer(head, np.uint8, 4 * distinct, k * 4 * distinct).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64) for k in range(2))
    used, order0 = np.cumsum(gaps), _Order0(shares, bits)
    at += packed
    sizes, sums = np.frombuffer(frame, "<u4", 2 * blocks, at).reshape(-1, 2).astype(np.int64).T
    at += blocks * ENTRY.size
    room = int(sizes.max()) // 4 + 4
    digits = np.zeros(blocks * room, np.uint32)
    for i, size in enumerate(sizes.tolist()):
        digits[i * room : i * room + size // 4] = np.frombuffer(frame, "<u4", size // 4, at)
        at += size
    digits = digits.astype(U)
    pos = np.arange(blocks, dtype=np.int64) * room
    code, width = (digits[pos] << HALF) | digits[pos + 1], np.full(blocks, 0xFFFFFFFFFFFFFFFF, U)
    pos += 2
    slots = np.repeat(np.arange(distinct), shares)
    last, shift0, most = len(digits) - 1, U(bits), U((1 << bits) - 1)
    model = _Model(blocks, order0)
    out = np.zeros((length, blocks), np.int64)
    for step in range(length):
        a, b = model.predict()
        unit = width >> U(12)
        first = unit * a.view(U)
        both = unit * (a + b).view(U)
        ok2, known = code < first, code < both
        x = np.where(ok2, model.p2, model.p1)
        start, wide = np.where(ok2, U(0), first), np.where(ok2, first, both - first)
        miss = np.flatnonzero(~known)
        if len(miss):
            begin = both[miss]
            rest = ((unit[miss] << U(12)) - begin) >> shift0
            name = slots.take(np.minimum((code[miss] - begin) // rest, most).astype(np.int64))
            x[miss] = name
            start[miss] = begin + rest * order0.starts.take(name)
            wide[miss] = rest * order0.shares.take(name)
        code -= start
        width = wide
        go = np.flatnonzero(width < LEAST)
        if len(go):
            at = pos[go]
            code[go] = (code[go] << HALF) | digits.take(np.minimum(at, last))
            width[go] <<= HALF
            pos[go] = at + 1
        out[step] = x
        model.update(x, model.p2 == x, model.p1 == x)
    ids = used[np.minimum(out.T.reshape(-1)[:n], distinct - 1)]
    raw = ids.astype("<u4")
    for i, expected in enumerate(sums.tolist()):
        if crc32(raw[i * length : (i + 1) * length].tobytes()) != expected:
            raise ValueError(f"block {i}: wrong checksum")
    return ids
