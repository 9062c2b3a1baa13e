"""Progressive JPEG: a lossless writer of coefficients and a decoder, vectorised over the restart intervals of many files.

Samples are carried as quantised coefficients (all quantisers are 1), byte b as b - 128, in zigzag order: first the blocks of
Y (sampled 2x2), then Cb and Cr. Scans: DC with one bit held back, AC by spectral bands with one bit held back, and the
refinements of both. The decoder adds the scans into coefficient arrays; inverse transform, chroma and colour are done in
whole numbers, so that equal files give equal tensors wherever they stand.
"""

from __future__ import annotations

import math
import struct
from bisect import bisect_left

import numpy as np

from .common import offsets, slices

UNIT = 576
INTERVAL = 16
#: (components, first, last, bits held back before, bits held back after)
SCANS = (((0, 1, 2), 0, 0, 0, 1), ((0,), 1, 5, 0, 1), ((0,), 6, 63, 0, 1), ((1,), 1, 63, 0, 1), ((2,), 1, 63, 0, 1), ((0, 1, 2), 0, 0, 1, 0), ((0,), 1, 63, 1, 0), ((1,), 1, 63, 1, 0), ((2,), 1, 63, 1, 0))
ZRL = 0xF0


def zigzag() -> np.ndarray:
    """Raster places in zigzag order."""
    cells = sorted(((r + c, r if (r + c) % 2 else c, r * 8 + c) for r in range(8) for c in range(8)))
    return np.array([x[2] for x in cells])


def _canonical(lengths: dict[int, int]) -> tuple[bytes, dict[int, tuple[int, int]]]:
    """DHT body and codes by symbol, shorter codes first, then in the order given."""
    order = sorted(lengths, key=lambda s: lengths[s])
    counts, codes, code, last = [0] * 16, {}, 0, 0
    for s in order:
        code <<= lengths[s] - last
        last = lengths[s]
        codes[s] = (code, last)
        counts[last - 1] += 1
        code += 1
    return bytes(counts) + bytes(order), codes


DC_BODY, DC_CODES = _canonical({s: 4 for s in range(9)})
# Letters less 128 and halved have four or three bits, a blank six.
_AC = {0x04: 1, 0x03: 2, 0x06: 3, 0x02: 4, 0x05: 5}
_AC |= {s: 12 for s in [*(r << 4 for r in range(16)), *(r << 4 | n for r in range(16) for n in range(1, 8))] if s not in _AC}
AC_BODY, AC_CODES = _canonical(_AC)


def _arrays(codes: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    code, length = np.zeros(256, np.int32), np.zeros(256, np.int32)
    for s, (c, n) in codes.items():
        code[s], length[s] = c, n
    return code, length


DC_CODE, DC_LEN = _arrays(DC_CODES)
AC_CODE, AC_LEN = _arrays(AC_CODES)
BITS = np.array([0, *(int(v).bit_length() for v in range(1, 4096))], np.int32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


HEAD = b"\xff\xd8" + _segment(0xDB, b"\0" + b"\1" * 64)
TABLES = _segment(0xC4, b"\x00" + DC_BODY) + _segment(0xC4, b"\x10" + AC_BODY) + _segment(0xDD, struct.pack(">H", INTERVAL))
SOS = [_segment(0xDA, bytes([len(c), *(x for k in c for x in (k + 1, 0)), a, b, h << 4 | low])) for c, a, b, h, low in SCANS]


class Layout:
    """Where the blocks of many files are: per file Y in raster order, then Cb, then Cr."""

    def __init__(self, cols: np.ndarray, rows: np.ndarray):
        self.cols, self.rows, self.mcus = cols, rows, cols * rows
        self.base = offsets(6 * self.mcus)
        self.files = len(cols)

    def blocks(self, comp: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of a component over all files, and how many each file has."""
        n = self.mcus * (4 if comp == 0 else 1)
        at = self.base[:-1] + (0 if comp == 0 else (3 + comp) * self.mcus)
        return np.repeat(at - offsets(n)[:-1], n) + np.arange(int(n.sum())), n

    def interleaved(self) -> tuple[np.ndarray, np.ndarray]:
        """Blocks in the order of interleaved scans, six for each MCU, and how many each file has."""
        n = self.mcus
        file = np.repeat(np.arange(self.files), n)
        i = np.arange(int(n.sum())) - np.repeat(offsets(n)[:-1], n)
        cols = self.cols[file]
        r, c = i // cols, i % cols
        y = self.base[:-1][file] + 2 * r * 2 * cols + 2 * c
        six = [y, y + 1, y + 2 * cols, y + 2 * cols + 1, self.base[:-1][file] + 4 * n[file] + i, self.base[:-1][file] + 5 * n[file] + i]
        return np.stack(six, axis=1).reshape(-1), 6 * n


def _lanes(counts: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """Restart intervals of `per` blocks: how many each file has, and the sizes of all."""
    many = -(-counts // per)
    size = np.full(int(many.sum()), per, np.int64)
    size[np.cumsum(many) - 1] = counts - (many - 1) * per
    return many, size


def _packed(code: np.ndarray, length: np.ndarray, lane: np.ndarray, many: np.ndarray) -> list[bytes]:
    """Codes as bits; intervals start on bytes, are filled with ones, stuffed and parted by restart markers. One string a file."""
    lanes = int(many.sum())
    bits = np.bincount(lane, length, lanes).astype(np.int64)
    size = (bits + 7) >> 3
    start = offsets(size)
    ends = np.searchsorted(lane, np.arange(lanes), side="right")
    run = np.cumsum(length)
    first = np.concatenate([[0], run[ends[:-1] - 1]])
    at = run - length - first[lane] + 8 * start[:-1][lane]
    fill = 8 * size - bits
    code, length, at = (np.insert(a, ends, b) for a, b in ((code, (1 << fill) - 1), (length, fill), (at, 8 * start[:-1] + bits)))
    window = code.astype(np.uint64) << (64 - (at & 31) - length).astype(np.uint64) if len(code) else np.zeros(0, np.uint64)
    window[length == 0] = 0
    word = at >> 5
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    both = np.bitwise_or.reduceat(window, heads)
    out = np.zeros((int(start[-1]) >> 2) + 3, np.uint64)
    out[word[heads]] |= both >> np.uint64(32)
    out[word[heads] + 1] |= both & np.uint64(0xFFFFFFFF)
    raw = out.astype(">u4").view(np.uint8)[: int(start[-1])]
    full = raw == 255
    last = np.zeros(lanes, bool)
    last[np.cumsum(many) - 1] = True
    stuffed = offsets(full)
    before = offsets(np.where(last, 0, 2))
    place = np.arange(len(raw)) + stuffed[:-1] + np.repeat(before[:-1], size)
    data = np.zeros(len(raw) + int(stuffed[-1]) + int(before[-1]), np.uint8)
    data[place] = raw
    inner = np.flatnonzero(~last)
    mark = start[inner + 1] + stuffed[start[inner + 1]] + before[inner]
    nth = np.arange(lanes) - np.repeat(offsets(many)[:-1], many)
    data[mark] = 255
    data[mark + 1] = 0xD0 + nth[inner] % 8
    cuts = offsets(many)
    edge = start[cuts] + stuffed[start[cuts]] + before[cuts]
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]


def _dc_first(coefs: np.ndarray, layout: Layout) -> list[bytes]:
    order, counts = layout.interleaved()
    many, size = _lanes(counts, 6 * INTERVAL)
    lane = np.repeat(np.arange(len(size)), size)
    value = coefs[order, 0].astype(np.int32) >> 1
    step = np.arange(len(order)) - np.repeat(offsets(size)[:-1], size)
    back = np.array([3, 1, 1, 1, 6, 6])[step % 6]  # the block before of the same component
    diff = value - np.where(step >= back, value[np.maximum(np.arange(len(order)) - back, 0)], 0)
    n = BITS[np.abs(diff)]
    return _packed((DC_CODE[n] << n) | np.where(diff < 0, diff + (1 << n) - 1, diff), DC_LEN[n] + n, lane, many)


def _dc_refine(coefs: np.ndarray, layout: Layout) -> list[bytes]:
    order, counts = layout.interleaved()
    many, size = _lanes(counts, 6 * INTERVAL)
    return _packed(coefs[order, 0].astype(np.int32) & 1, np.ones(len(order), np.int32), np.repeat(np.arange(len(size)), size), many)


def _ac_first(coefs: np.ndarray, layout: Layout, comp: int, first: int, last: int) -> list[bytes]:
    order, counts = layout.blocks(comp)
    many, size = _lanes(counts, INTERVAL)
    part = coefs[order, first : last + 1].astype(np.int32)
    part = np.sign(part) * (np.abs(part) >> 1)
    row, col = np.nonzero(part)
    value = part[row, col]
    fresh = np.diff(row, prepend=-1) != 0
    run = col - np.where(fresh, 0, np.concatenate([[0], col[:-1] + 1]))
    skips, run = run >> 4, run & 15
    n = BITS[np.abs(value)]
    symbol = run << 4 | n
    per_row = np.bincount(row, minlength=len(order))
    seen = offsets(per_row)
    open_end = np.ones(len(order), bool)
    tails = seen[1:][per_row > 0] - 1
    open_end[row[tails]] = col[tails] != last - first
    ended, skipped = offsets(open_end), offsets(skips)
    at = np.arange(len(row)) + skipped[1:] + ended[row]
    total = len(row) + int(skipped[-1]) + int(ended[-1])
    code, length = np.full(total, AC_CODE[ZRL]), np.full(total, AC_LEN[ZRL])
    code[at] = (AC_CODE[symbol] << n) | np.where(value < 0, value + (1 << n) - 1, value)
    length[at] = AC_LEN[symbol] + n
    stop = np.flatnonzero(open_end)
    stop_at = seen[stop + 1] + skipped[seen[stop + 1]] + ended[stop]
    code[stop_at], length[stop_at] = AC_CODE[0], AC_LEN[0]
    per_row = per_row + open_end
    np.add.at(per_row, row, skips)
    return _packed(code, length, np.repeat(np.repeat(np.arange(len(size)), size), per_row), many)


def _refined_interval(block: np.ndarray) -> tuple[list[int], list[int]]:
    """Codes of an interval in which coefficients become nonzero only now; written block by block."""
    codes, lengths = [], []

    def put(code: int, length: int) -> None:
        codes.append(code)
        lengths.append(length)

    for row in block.tolist():
        new = [k for k, v in enumerate(row) if abs(v) == 1]
        held: list[int] = []
        run = 0
        for k, v in enumerate(row):
            if not new or k > new[-1]:
                break
            if v == 0 or abs(v) > 1:
                if v:
                    held.append(abs(v) & 1)
                elif run == 15:
                    # sixteen zeros and the correction bits met so far
                    put(*AC_CODES[ZRL])
                    for b in held:
                        put(b, 1)
                    held, run = [], 0
                else:
                    run += 1
            else:
                put(*AC_CODES[run << 4 | 1])
                put(int(v > 0), 1)
                for b in held:
                    put(b, 1)
                held, run = [], 0
        rest = row[new[-1] + 1 if new else 0 :]
        if rest:
            put(*AC_CODES[0])
            for v in rest:
                if abs(v) > 1:
                    put(abs(v) & 1, 1)
    return codes, lengths


def _ac_refine(coefs: np.ndarray, layout: Layout, comp: int) -> list[bytes]:
    order, counts = layout.blocks(comp)
    many, size = _lanes(counts, INTERVAL)
    part = coefs[order, 1:].astype(np.int32)
    known = np.abs(part) > 1
    edges = offsets(size)
    lane_of = np.repeat(np.arange(len(size)), size)
    odd = np.unique(lane_of[(np.abs(part) == 1).any(axis=1)])
    plain = np.ones(len(size), bool)
    plain[odd] = False
    # usually one run of ended blocks holds the whole interval, followed by all its correction bits
    row, col = np.nonzero(known & plain[lane_of][:, None])
    bits = np.abs(part[row, col]) & 1
    own = np.bincount(lane_of[row], minlength=len(size)) + plain
    exact = {int(i): _refined_interval(part[edges[i] : edges[i + 1]]) for i in odd}
    for i, (c, _) in exact.items():
        own[i] = len(c)
    start = offsets(own)
    code, length = np.zeros(int(start[-1]), np.int32), np.ones(int(start[-1]), np.int32)
    rank = np.arange(len(row)) - offsets(np.bincount(lane_of[row], minlength=len(size)))[:-1][lane_of[row]]
    code[start[:-1][lane_of[row]] + 1 + rank] = bits
    k = BITS[size] - 1
    head = start[:-1][plain]
    code[head] = ((AC_CODE[k << 4] << k) | (size - (1 << k)))[plain]
    length[head] = (AC_LEN[k << 4] + k)[plain]
    for i, (c, n) in exact.items():
        code[start[i] : start[i + 1]], length[start[i] : start[i + 1]] = c, n
    return _packed(code, length, np.repeat(np.arange(len(size)), own), many)


def padded(text: bytes | None) -> bytes:
    text = text or b""
    return text + b"\xff" * (-len(text) % UNIT or (0 if text else UNIT))


def encode(texts: list[bytes | None]) -> list[bytes]:
    """A progressive JPEG for each text (null: empty); its size without padding is in a comment. Few at a time, for the caches' sake."""
    return [f for a, b in slices(texts, 200_000) for f in _encode(texts[a:b])]


def _encode(texts: list[bytes | None]) -> list[bytes]:
    payloads = [padded(t) for t in texts]
    blocks = np.array([len(p) // 64 for p in payloads], np.int64)
    need = -(-blocks // 6)
    cols = np.ceil(np.sqrt(need)).astype(np.int64)
    layout = Layout(cols, -(-need // cols))
    coefs = np.zeros((int(layout.base[-1]), 64), np.int16)
    at = np.repeat(layout.base[:-1] - offsets(blocks)[:-1], blocks) + np.arange(int(blocks.sum()))
    coefs[at] = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, 64).astype(np.int16) - 128
    scans = []
    for comps, first, last, high, _ in SCANS:
        if first == 0:
            scans.append(_dc_refine(coefs, layout) if high else _dc_first(coefs, layout))
        else:
            scans.append(_ac_refine(coefs, layout, comps[0]) if high else _ac_first(coefs, layout, comps[0], first, last))
    out = []
    for i, text in enumerate(texts):
        frame = struct.pack(">BHHB", 8, 16 * int(layout.rows[i]), 16 * int(layout.cols[i]), 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        out.append(b"".join([HEAD, _segment(0xFE, b"n_bytes=%d" % len(text or b"")), _segment(0xC2, frame), TABLES, *(x for k, s in enumerate(scans) for x in (SOS[k], s[i])), b"\xff\xd9"]))
    return out


class _Huffman:
    """16 bits ahead: length of the code and its symbol; tables of several files side by side."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.luts: list[np.ndarray] = []

    def index(self, body: bytes) -> int:
        if body not in self.known:
            lut, code, at = np.zeros(65536, np.int64), 0, 16
            for n in range(1, 17):
                for s in body[at : at + body[n - 1]]:
                    lut[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | s
                    code += 1
                at += body[n - 1]
                code <<= 1
            self.known[body] = len(self.luts)
            self.luts.append(lut)
        return self.known[body]

    def table(self) -> np.ndarray:
        return np.concatenate(self.luts)


def _parsed(data: bytes, marks: list[int], begin: int, huffman: _Huffman) -> dict:
    """Headers and scans of one file that starts at `begin`; marks: where entropy-coded data can end."""
    at, found = begin + 2, {"scans": [], "n_bytes": None, "interval": 0}
    tables: dict[int, int] = {}
    quant: dict[int, np.ndarray] = {}
    while True:
        marker = data[at + 1]
        if marker == 0xD9:
            return found | {"quant": quant}
        size = data[at + 2] << 8 | data[at + 3]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                if body[0] >> 4:
                    raise ValueError("16-bit quantisers aren't read")
                quant[body[0] & 15] = np.frombuffer(body[1:65], np.uint8).astype(np.float64)
                body = body[65:]
        elif marker == 0xFE and body.startswith(b"n_bytes="):
            found["n_bytes"] = int(body[8:])
        elif marker == 0xC2:
            height, width = struct.unpack(">HH", body[1:5])
            if body[0] != 8 or body[5] != 3 or [body[7], body[10], body[13]] != [0x22, 0x11, 0x11] or height % 16 or width % 16:
                raise ValueError("only 8-bit images with three components, sampled 4:2:0 in whole MCUs, are read")
            found |= {"height": height, "width": width, "ids": [body[6], body[9], body[12]], "q": [body[8], body[11], body[14]]}
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a progressive JPEG")
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                tables[body[0]] = huffman.index(bytes(body[1:n]))
                body = body[n:]
        elif marker == 0xDD:
            found["interval"] = body[0] << 8 | body[1]
        elif marker == 0xDA:
            n = body[0]
            comps = tuple(found["ids"].index(body[1 + 2 * k]) for k in range(n))
            if body[1 + 2 * n] == 0 and n != 3:
                raise ValueError("DC scans are read with all three components only")
            ac = body[1 + 2 * n] > 0
            use = tuple(tables.get(16 | body[2 + 2 * k] & 15 if ac else body[2 + 2 * k] >> 4, 0) for k in range(n))
            end = marks[bisect_left(marks, at)]
            found["scans"].append((comps, body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15, use, at, end, found["interval"]))
            at = end


class _Bits:
    """Entropy-coded data of one kind of scan over many files: without stuffing, cut at restart markers."""

    def __init__(self, data: np.ndarray, spans: list[tuple[int, int]], restarts: np.ndarray):
        begin, end = np.array([s[0] for s in spans], np.int64), np.array([s[1] for s in spans], np.int64)
        size = end - begin
        take = np.repeat(begin - offsets(size)[:-1], size) + np.arange(int(size.sum()))
        raw = data[take]
        ff = raw == 255
        prev = np.concatenate([[False], ff[:-1]])
        stuffing = prev & (raw == 0)
        marker = prev & (raw >= 0xD0) & (raw <= 0xD7)
        drop = stuffing | marker
        drop[np.flatnonzero(marker) - 1] = True
        kept = offsets(~drop)
        starts = np.sort(np.concatenate([offsets(size)[:-1], np.flatnonzero(marker) + 1]))
        self.at = kept[starts] * 8
        self.file = np.searchsorted(offsets(size), starts, side="right") - 1
        pure = np.concatenate([raw[~drop], np.zeros(8, np.uint8)]).astype(np.uint32)
        self.bytes = pure
        self.window = (pure[:-3] << np.uint32(24) | pure[1:-2] << np.uint32(16) | pure[2:-1] << np.uint32(8) | pure[3:]).astype(np.int64)

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.bytes[at >> 3].astype(np.int64) >> (7 - (at & 7))) & 1


def _read_dc_first(coefs, bits, table, use, order, size, low):
    lanes = len(size)
    start, at = offsets(size)[:-1], bits.at.copy()
    pred = np.zeros((3, lanes), np.int64)
    for step in range(int(size.max())):
        on = np.flatnonzero(size > step)
        comp = (0, 0, 0, 0, 1, 2)[step % 6]
        w = (bits.window[at[on] >> 3] << (at[on] & 7)) & 0xFFFFFFFF
        e = table[use[comp][on] + (w >> 16)]
        n, length = e & 255, e >> 8
        value = (w >> (32 - length - n)) & ((1 << n) - 1)
        pred[comp][on] += np.where((n > 0) & (value < (1 << n >> 1)), value - (1 << n) + 1, value)
        coefs[order[start[on] + step], 0] = pred[comp][on] << low
        at[on] += length + n


def _read_dc_refine(coefs, bits, order, size, low):
    step = np.arange(len(order)) - np.repeat(offsets(size)[:-1], size)
    coefs[order, 0] |= (bits.bit(np.repeat(bits.at, size) + step) << low).astype(coefs.dtype)


def _read_ac_first(coefs, bits, table, use, order, size, first, last, low):
    flat = coefs.reshape(-1)
    at, block, left, use, k = bits.at.copy(), offsets(size)[:-1].copy(), size.copy(), use.copy(), np.full(len(size), first)
    for step in range(1 << 40):
        if step % 32 == 0:
            on = left > 0
            if not on.all():
                if not on.any():
                    return
                at, block, left, use, k = at[on], block[on], left[on], use[on], k[on]
        w = (bits.window.take(at >> 3, mode="clip") << (at & 7)) & 0xFFFFFFFF
        e = table.take(use + (w >> 16))
        n, run, length = e & 15, (e >> 4) & 15, e >> 8
        stop = (n == 0) & (run < 15)
        extra = np.where(stop, run, n)
        value = (w >> (32 - length - extra)) & ((1 << extra) - 1)
        k += run
        put = np.flatnonzero((n > 0) & (left > 0))
        here, m = value[put], n[put]
        flat[order.take(block[put]) * 64 + k[put]] = np.where(here < (1 << m >> 1), here - (1 << m) + 1, here) << low
        at += length + extra
        k += 1
        over = stop | (k > last)
        if over.any():
            skip = np.where(stop, (1 << extra) + value, 1)
            skip = np.minimum(np.where(over, skip, 0), left)
            block += skip
            left -= skip
            k[over] = first
            np.minimum(block, len(order) - 1, out=block)


def _read_interval(rows: np.ndarray, bits: _Bits, at: int, table: np.ndarray, low: int) -> None:
    """Refine one interval, coefficient by coefficient."""
    one = 1 << low

    def take(n: int) -> int:
        nonlocal at
        out = 0
        for _ in range(n):
            out = out << 1 | int(bits.bytes[at >> 3]) >> (7 - (at & 7)) & 1
            at += 1
        return out

    def correct(row: np.ndarray, k: int) -> None:
        if take(1):
            row[k] += one if row[k] > 0 else -one

    ended = 0
    for row in rows:
        k = 0
        if ended:
            ended -= 1
            for j in np.flatnonzero(row):
                correct(row, j)
            continue
        while k < len(row):
            ahead = int.from_bytes(bytes(bits.bytes[at >> 3 : (at >> 3) + 3].astype(np.uint8)), "big") >> (8 - (at & 7)) & 0xFFFF
            e = int(table[ahead])
            at += e >> 8
            run, n = (e >> 4) & 15, e & 15
            if n == 0 and run < 15:
                ended = (1 << run) + take(run) - 1
                for j in range(k, len(row)):
                    if row[j]:
                        correct(row, j)
                break
            new = (one if take(1) else -one) if n else 0
            while k < len(row):
                if row[k]:
                    correct(row, k)
                elif run == 0:
                    row[k] = new
                    k += 1
                    break
                else:
                    run -= 1
                k += 1


def _read_ac_refine(coefs, bits, table, use, order, size, first, last, low):
    w = (bits.window[bits.at >> 3] << (bits.at & 7)) & 0xFFFFFFFF
    e = table[use + (w >> 16)]
    n, run, length = e & 15, (e >> 4) & 15, e >> 8
    whole = (n == 0) & (run < 15) & ((1 << run) + ((w >> (32 - length - run)) & ((1 << run) - 1)) >= size)
    lane_of = np.repeat(np.arange(len(size)), size)
    part = coefs[order, first : last + 1]
    row, col = np.nonzero((part != 0) & whole[lane_of][:, None])
    lane = lane_of[row]
    rank = np.arange(len(row)) - offsets(np.bincount(lane, minlength=len(size)))[:-1][lane]
    bit = bits.bit((bits.at + length + run)[lane] + rank)
    value = part[row, col]
    part[row, col] = value + (np.sign(value) * (bit << low)).astype(part.dtype)
    edges = offsets(size)
    for i in np.flatnonzero(~whole):
        _read_interval(part[edges[i] : edges[i + 1]], bits, int(bits.at[i]), table[use[i] : use[i] + 65536], low)
    coefs[order, first : last + 1] = part


def coefficients(files: list[bytes]) -> tuple[np.ndarray, Layout, list[dict]]:
    """Coefficients of all blocks in zigzag order, accumulated over the scans."""
    data, huffman = b"".join(files), _Huffman()
    raw = np.frombuffer(data + b"\xff\xd9", np.uint8)
    after = raw[1:]
    marks = np.flatnonzero((raw[:-1] == 255) & (after != 0) & ((after < 0xD0) | (after > 0xD7)) & (after != 255))
    marks = marks.tolist()
    begins = offsets([len(f) for f in files])
    infos = [_parsed(data, marks, int(b), huffman) for b in begins[:-1]]
    if any(len(i["scans"]) != len(infos[0]["scans"]) or any(a[:5] != b[:5] for a, b in zip(i["scans"], infos[0]["scans"], strict=True)) for i in infos):
        out = [coefficients([f]) for f in files]  # scripts of their own: one at a time
        layout = Layout(np.concatenate([o[1].cols for o in out]), np.concatenate([o[1].rows for o in out]))
        return np.concatenate([o[0] for o in out]), layout, [o[2][0] for o in out]
    layout = Layout(np.array([i["width"] // 16 for i in infos]), np.array([i["height"] // 16 for i in infos]))
    coefs = np.zeros((int(layout.base[-1]), 64), np.int16)
    table = huffman.table()
    interleaved = layout.interleaved()
    for s, (comps, first, last, high, low, *_) in enumerate(infos[0]["scans"]):
        own = [i["scans"][s] for i in infos]
        bits = _Bits(raw, [(x[6], x[7]) for x in own], raw)
        use = [np.array([x[5][c] for x in own], np.int64)[bits.file] * 65536 for c in range(len(comps))]
        order, counts = interleaved if first == 0 else layout.blocks(comps[0])
        every = np.array([x[8] or 1 << 40 for x in own], np.int64) * (6 if first == 0 else 1)
        many = -(-counts // every)
        size = np.repeat(np.minimum(every, counts), many)
        size[np.cumsum(many) - 1] = counts - (many - 1) * every
        if len(size) != len(bits.at):
            raise ValueError("restart intervals are missing")
        if first == 0:
            _read_dc_refine(coefs, bits, order, size, low) if high else _read_dc_first(coefs, bits, table, use, order, size, low)
        elif high:
            _read_ac_refine(coefs, bits, table, use[0], order, size, first, last, low)
        else:
            _read_ac_first(coefs, bits, table, use[0], order, size, first, last, low)
    return coefs, layout, infos


SHIFT = 11


def _basis() -> np.ndarray:
    """Rows: coefficients in zigzag order; columns: samples in raster order; in 1/2048. Sums stay below 2^24, so they're exact."""
    c = np.array([[math.cos((2 * x + 1) * u * math.pi / 16) * (math.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
    full = np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)
    return np.rint(full[zigzag()] * (1 << SHIFT))


BASIS = _basis()


def tensors(coefs: np.ndarray, layout: Layout, infos: list[dict]) -> list[np.ndarray]:
    """Full-resolution RGB of each file: inverse transform, chroma repeated over 2x2 samples, colour conversion."""
    plain = all((i["quant"][q] == 1).all() for i in infos for q in i["q"]) and int(np.abs(coefs).max(initial=0)) <= 128
    if plain:
        blocks = coefs.astype(np.float32) @ BASIS.astype(np.float32)
    else:
        scaled = coefs.astype(np.float64)
        for f, info in enumerate(infos):
            a, m = int(layout.base[f]), int(layout.mcus[f])
            for c, (x, y) in enumerate(((0, 4 * m), (4 * m, 5 * m), (5 * m, 6 * m))):
                scaled[a + x : a + y] *= info["quant"][info["q"][c]]
        blocks = scaled @ BASIS
    samples = np.clip((blocks.astype(np.int64) + (1 << (SHIFT - 1)) >> SHIFT) + 128, 0, 255).astype(np.int32).reshape(-1, 8, 8)
    out = []
    for f in range(layout.files):
        rows, cols, a, m = int(layout.rows[f]), int(layout.cols[f]), int(layout.base[f]), int(layout.mcus[f])

        def plane(begin: int, r: int, c: int) -> np.ndarray:
            return samples[begin : begin + r * c].reshape(r, c, 8, 8).swapaxes(1, 2).reshape(8 * r, 8 * c)

        y = plane(a, 2 * rows, 2 * cols)
        cb, cr = ((plane(a + k * m, rows, cols) - 128).repeat(2, 0).repeat(2, 1) for k in (4, 5))
        rgb = np.empty((16 * rows, 16 * cols, 3), np.uint8)
        # 1.402, 0.344136, 0.714136 and 1.772 in 1/65536
        rgb[..., 0] = np.clip(y + (91881 * cr + 32768 >> 16), 0, 255)
        rgb[..., 1] = np.clip(y - (22554 * cb + 46802 * cr + 32768 >> 16), 0, 255)
        rgb[..., 2] = np.clip(y + (116130 * cb + 32768 >> 16), 0, 255)
        out.append(rgb)
    return out


def payloads(coefs: np.ndarray, layout: Layout, infos: list[dict]) -> list[bytes]:
    """What encode() stored, with its padding."""
    out = []
    for f, info in enumerate(infos):
        n = -(-max(info["n_bytes"], 1) // UNIT) * UNIT
        a = int(layout.base[f])
        out.append((coefs[a : a + n // 64] + 128).astype(np.uint8).tobytes())
    return out
