"""Progressive JPEG in numpy: a decoder that accumulates spectral-selection and successive-approximation scans into
coefficient arrays, and an encoder for given coefficients.

Restart intervals are independent, so those of all images of a batch are decoded side by side, a symbol of each at a
time. An image without restart markers is one such lane.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

import numpy as np

#: Zigzag order: by anti-diagonals, every other one reversed.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
#: The inverse transform of one block as a matrix of whole numbers, so that sums in any order are exact.
SCALE = 1 << 13
_C = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
INVERSE = np.rint(np.einsum("uy,vx->uvyx", _C, _C).reshape(64, 64) * SCALE)


@dataclass
class Scan:
    parts: tuple[int, ...]
    start: int
    end: int
    high: int
    low: int
    dc: tuple[bytes, ...]
    ac: tuple[bytes, ...]
    restart: int
    data: bytes


@dataclass
class Image:
    height: int
    width: int
    sampling: list[tuple[int, int]]
    quant: list[np.ndarray]
    scans: list[Scan]
    comments: list[bytes] = field(default_factory=list)
    base: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        hm, vm = max(s[0] for s in self.sampling), max(s[1] for s in self.sampling)
        self.mcus = rows, cols = -(-self.height // (8 * vm)), -(-self.width // (8 * hm))
        self._grid = [(rows * v, cols * h) for h, v in self.sampling]
        self._shown = [(-(-(-(-self.height * v // vm)) // 8), -(-(-(-self.width * h // hm)) // 8)) for h, v in self.sampling]

    def grid(self, part: int) -> tuple[int, int]:
        """Rows and columns of a component's blocks, padded to whole MCUs."""
        return self._grid[part]

    def shown(self, part: int) -> tuple[int, int]:
        """Rows and columns of blocks that a scan of this component alone holds."""
        return self._shown[part]


#: A marker that is neither a stuffed byte nor a restart.
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]", re.DOTALL).search


def parse(raw: bytes) -> Image:
    """Markers of a progressive image; entropy-coded data stay as they are. Raises ValueError on others."""
    if raw[:2] != b"\xff\xd8":
        raise ValueError("no JPEG image")
    at, quant, huff, restart, frame, scans, comments = 2, {}, {}, 0, None, [], []
    while at + 4 <= len(raw):
        if raw[at] != 0xFF:
            raise ValueError("marker expected")
        kind = raw[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        if kind == 0xD9:
            break
        size = struct.unpack_from(">H", raw, at + 2)[0]
        body = raw[at + 4 : at + 2 + size]
        at += 2 + size
        if kind == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                quant[body[k] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, k + 1).astype(np.int64)
                k += 65 + 64 * bool(wide)
        elif kind == 0xC4:
            k = 0
            while k < len(body):
                n = sum(body[k + 1 : k + 17])
                huff[body[k]] = body[k + 1 : k + 17 + n]
                k += 17 + n
        elif kind == 0xC2:
            height, width, n = struct.unpack_from(">HHB", body, 1)
            frame = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise ValueError("not a progressive Huffman image")
        elif kind == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif kind == 0xFE:
            comments.append(body)
        elif kind == 0xDA:
            n = body[0]
            ids = [c[0] for c in frame]
            parts = tuple(ids.index(body[1 + 2 * i]) for i in range(n))
            start, end, approx = body[1 + 2 * n : 4 + 2 * n]
            found = _MARKER(raw, at)
            if found is None:
                raise ValueError("a scan has no end")
            end_at = found.start()
            tables = [(huff.get(body[2 + 2 * i] >> 4, b""), huff.get(0x10 | (body[2 + 2 * i] & 15), b"")) for i in range(n)]
            scans.append(Scan(parts, start, end, approx >> 4, approx & 15, tuple(t[0] for t in tables), tuple(t[1] for t in tables), restart, raw[at:end_at]))
            at = end_at
    if frame is None:
        raise ValueError("no frame")
    return Image(height, width, [(h, v) for _, h, v, _ in frame], [quant[q] for *_, q in frame], scans, comments)


_TABLES: dict[bytes, np.ndarray] = {}


def lookup(spec: bytes) -> np.ndarray:
    """For all 16-bit strings: length of the code that they begin with, times 256, plus its symbol."""
    if spec not in _TABLES:
        out, code, k = np.zeros(1 << 16, np.int64), 0, 16
        for length in range(1, 17):
            for _ in range(spec[length - 1]):
                first = code << (16 - length)
                out[first : first + (1 << (16 - length))] = length << 8 | spec[k]
                code, k = code + 1, k + 1
            code <<= 1
        _TABLES[spec] = out
    return _TABLES[spec]


_DIRECT: dict[bytes, np.ndarray] = {}


def direct(spec: bytes) -> np.ndarray:
    """For all 16-bit strings that begin with an AC code and all bits of its value: value << 16 | run << 5 | bits used.
    0 where the string is too short or the symbol has no value."""
    if spec not in _DIRECT:
        entry = lookup(spec)
        length, s, r = entry >> 8, entry & 15, (entry & 255) >> 4
        used = length + s
        v = (np.arange(1 << 16) >> np.maximum(16 - used, 0)) & ((1 << s) - 1)
        _DIRECT[spec] = np.where((s > 0) & (used <= 16), _extend(v, s) << 16 | r << 5 | used, 0).astype(np.int32)
    return _DIRECT[spec]


def intervals(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes without stuffing and restart markers, and where each interval begins."""
    ff = np.flatnonzero(data[:-1] == 0xFF) if len(data) else np.zeros(0, np.int64)
    follow = data[ff + 1]
    keep = np.ones(len(data), bool)
    keep[ff[follow == 0] + 1] = False
    marks = ff[(follow >= 0xD0) & (follow <= 0xD7)]
    keep[marks] = False
    keep[marks + 1] = False
    before = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], np.concatenate([[0], before[marks]])


class Bits:
    """40 bits from each byte of the data on."""

    def __init__(self, data: np.ndarray):
        x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.int64)
        self.window = (x[:-4] << 32) | (x[1:-3] << 24) | (x[2:-2] << 16) | (x[3:-1] << 8) | x[4:]


def _extend(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(v < (1 << np.maximum(s - 1, 0)), v - (1 << s) + 1, v)


def _first_ac(coefs, bits, spec, pos, base, left, start, end, low) -> None:
    table, quick = lookup(spec), direct(spec)
    at, stop = base + start, base + end  # the coefficient that comes next, and the last of the band in its block
    window = bits.window
    while len(pos):
        w, sh = window[pos >> 3], pos & 7
        entry = quick[(w >> (24 - sh)) & 0xFFFF]
        at += (entry >> 5) & 15
        odd = np.flatnonzero(entry == 0)
        if len(odd):
            _odd_symbols(coefs, window, table, odd, pos, at, stop, left, w, sh, low)
            put = entry != 0
            coefs[at[put]] = (entry[put] >> 16) << low
        else:
            coefs[at] = (entry >> 16) << low
        pos += entry & 31
        at += 1
        full = np.flatnonzero(at > stop)
        if len(full):
            stop[full] += 64
            at[full] = stop[full] - (end - start)
            left[full] -= 1
            if (left[full] <= 0).any():
                on = left > 0
                pos, at, stop, left = pos[on], at[on], stop[on], left[on]


def _odd_symbols(coefs, window, table, odd, pos, at, stop, left, w, sh, low) -> None:
    """Symbols that the direct table doesn't hold: long values, runs of 16 zeros, and ends of bands."""
    entry = table[(w[odd] >> (24 - sh[odd])) & 0xFFFF]
    length, s, r = entry >> 8, entry & 15, (entry & 255) >> 4
    ends = (s == 0) & (r < 15)
    more = np.where(ends, r, s)
    pos[odd] += length
    w2, sh2 = window[pos[odd] >> 3], pos[odd] & 7
    v = (w2 >> (40 - sh2 - more)) & ((1 << more) - 1)
    pos[odd] += more
    at[odd] += np.where(ends, 0, r)
    value = s > 0
    coefs[at[odd[value]]] = _extend(v[value], s[value]) << low
    blocks = odd[ends]
    skip = (1 << r[ends]) + v[ends] - 1  # whole blocks beyond this one
    stop[blocks] += 64 * skip
    left[blocks] -= skip
    at[blocks] = stop[blocks]


def _refine_ac(coefs, bits, table, pos, base, left, start, end, low) -> None:
    window, one = bits.window, 1 << low
    n = len(pos)
    k, eob, run, new = np.full(n, start), np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64)
    while len(pos):
        q = np.flatnonzero((eob == 0) & (run < 0))
        if len(q):
            w, sh = window[pos[q] >> 3], pos[q] & 7
            entry = table[(w >> (24 - sh)) & 0xFFFF]
            length, s, r = entry >> 8, entry & 15, (entry & 255) >> 4
            stop = (s == 0) & (r < 15)
            more = np.where(stop, r, np.minimum(s, 1))
            v = (w >> (40 - sh - length - more)) & ((1 << more) - 1)
            pos[q] += length + more
            eob[q] = np.where(stop, (1 << r) + v, 0)
            run[q] = np.where(stop, -1, r)
            new[q] = np.where(s > 0, np.where(v == 1, one, -one), 0)
        at = base + k
        c = coefs[at].astype(np.int64)
        old = c != 0
        bit = (window[pos >> 3] >> (39 - (pos & 7))) & 1
        pos = pos + old
        change = np.where(old, bit * np.where(c > 0, one, -one), 0)
        here = ~old & (eob == 0) & (run == 0)
        coefs[at] = np.where(here, new, c + change)
        run = np.where(here, -1, run - (~old & (eob == 0) & (run > 0)))
        k += 1
        full = k > end
        if full.any():
            base = base + 64 * full
            left = left - full
            eob = eob - (full & (eob > 0))
            run = np.where(full, -1, run)
            k[full] = start
            on = left > 0
            if not on.all():
                pos, base, left, k, eob, run, new = (x[on] for x in (pos, base, left, k, eob, run, new))


def _dc(coefs, bits, tables, pos, blocks, high, low) -> None:
    """blocks: for each lane the coefficient base of each of its blocks in order (-1: none) and its component."""
    bases, parts = blocks
    last: dict[int, np.ndarray] = {p: np.zeros(len(pos), np.int64) for p in np.unique(parts)}
    for step in range(bases.shape[1]):
        on = np.flatnonzero(bases[:, step] >= 0)
        at = bases[on, step]
        p = int(parts[step])
        w, sh = bits.window[pos[on] >> 3], pos[on] & 7
        if high:
            coefs[at] |= ((((w >> (39 - sh)) & 1) << low)).astype(coefs.dtype)
            pos[on] += 1
            continue
        entry = tables[p][(w >> (24 - sh)) & 0xFFFF]
        length, s = entry >> 8, entry & 255
        v = (w >> (40 - sh - length - s)) & ((1 << s) - 1)
        pos[on] += length + s
        last[p][on] += np.where(s > 0, _extend(v, s), 0)
        coefs[at] = last[p][on] << low


def _alone(img: Image, part: int) -> np.ndarray:
    """Block numbers of a component in the order of a scan of it alone."""
    (rows, cols), wide = img.shown(part), img.grid(part)[1]
    return np.arange(rows * cols) if cols == wide else (np.arange(rows)[:, None] * wide + np.arange(cols)).ravel()


def _together(img: Image, parts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(MCU, block) tables of block bases, and the component of each of an MCU's blocks."""
    rows, cols = img.mcus
    out, owner = [], []
    for p in parts:
        h, v = img.sampling[p]
        for y in range(v):
            for x in range(h):
                out.append(((np.arange(rows)[:, None] * v + y) * img.grid(p)[1] + np.arange(cols) * h + x).ravel() * 64 + img.base[p])
                owner.append(p)
    return np.stack(out, axis=1), np.array(owner)


def _waves(img: Image) -> list[tuple[tuple, list[Scan]]]:
    """Scans in order; neighbours that differ in their component only are one wave."""
    out: list[tuple[tuple, list[Scan]]] = []
    for s in img.scans:
        solo = len(s.parts) == 1
        key = (s.start, s.end, s.high, s.low, s.dc if s.start == 0 else s.ac, solo or s.parts)
        if solo and out and out[-1][0] == key and all(s.parts != o.parts for o in out[-1][1]):
            out[-1][1].append(s)
        else:
            out.append((key, [s]))
    return out


def coefficients(images: list[Image]) -> np.ndarray:
    """All images' coefficients in zigzag order, a row a block; each image's `base` says where its components begin."""
    at = 0
    for img in images:
        img.base = []
        for p in range(len(img.sampling)):
            img.base.append(at)
            rows, cols = img.grid(p)
            at += rows * cols * 64
    coefs = np.zeros(at, np.int16)
    waves = [_waves(img) for img in images]
    for n in range(max(map(len, waves), default=0)):
        groups: dict[tuple, list[tuple[Image, Scan]]] = {}
        for img, own in zip(images, waves, strict=True):
            if n < len(own):
                groups.setdefault(own[n][0], []).extend((img, s) for s in own[n][1])
        for key, held in groups.items():
            _decode(coefs, key, held)
    return coefs.reshape(-1, 64)


def _decode(coefs: np.ndarray, key: tuple, held: list[tuple[Image, Scan]]) -> None:
    start, end, high, low, tables, together = key
    raw, starts = intervals(np.concatenate([np.frombuffer(s.data + b"\xff\xd0", np.uint8) for _, s in held] + [np.zeros(1, np.uint8)]))
    starts = starts[:-1]  # every scan was closed by a mark
    bits = Bits(raw)
    if start == 0:
        lanes, owner = [], np.array([0])
        for img, s in held:
            if together is True:
                order, owner = (_alone(img, s.parts[0]) * 64 + img.base[s.parts[0]])[:, None], np.array([0])
            else:
                order, owner = _together(img, s.parts)
            step = s.restart or len(order)
            whole = len(order) // step
            if whole:
                lanes.append(order[: whole * step].reshape(whole, -1))
            if whole * step < len(order):
                lanes.append(order[whole * step :].reshape(1, -1))
        wide = max(x.shape[1] for x in lanes)
        bases = np.full((sum(len(x) for x in lanes), wide), -1)
        at = 0
        for x in lanes:
            bases[at : at + len(x), : x.shape[1]] = x
            at += len(x)
        of = {int(p): lookup(tables[list(dict.fromkeys(owner.tolist())).index(p)]) for p in np.unique(owner)} if not high else {}
        _dc(coefs, bits, of, starts * 8, (bases, np.resize(owner, wide)), high, low)
        return
    totals, firsts, steps = [], [], []
    for img, s in held:
        rows, cols = img.shown(s.parts[0])
        totals.append(rows * cols)
        firsts.append(img.base[s.parts[0]])
        steps.append(s.restart or rows * cols)
    # Where rows aren't whole MCUs, a scan's blocks don't follow one another: it is decoded into a copy that has them so.
    apart = any(img.shown(s.parts[0])[1] != img.grid(s.parts[0])[1] for img, s in held)
    if apart:
        places = [_alone(img, s.parts[0]) + img.base[s.parts[0]] // 64 for img, s in held]
        order, target = np.concatenate(places), coefs
        coefs = target.reshape(-1, 64)[order].reshape(-1)
        firsts = (np.cumsum([0, *totals[:-1]]) * 64).tolist()
    total, first, step = np.array(totals), np.array(firsts), np.array(steps)
    count = -(-total // step)
    owner = np.repeat(np.arange(len(total)), count)
    begin = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * step[owner]
    base, left = first[owner] + begin * 64, np.minimum(step[owner], total[owner] - begin)
    lanes = (starts * 8, base, left, start, end, low)
    if high:
        _refine_ac(coefs, bits, lookup(tables[0]), *lanes)
    else:
        _first_ac(coefs, bits, tables[0], *lanes)
    if apart:
        target.reshape(-1, 64)[order] = coefs.reshape(-1, 64)


def samples(images: list[Image], coefs: np.ndarray) -> np.ndarray:
    """All blocks' samples, 0 to 255, in rows of 64: dequantised and transformed."""
    out = np.empty(coefs.shape, np.uint8)
    groups: dict[bytes, list[tuple[int, int]]] = {}
    for img in images:
        for p, q in enumerate(img.quant):
            rows, cols = img.grid(p)
            own = groups.setdefault(np.asarray(q, np.int64).tobytes(), [])
            first = img.base[p] // 64
            if own and own[-1][1] == first:
                own[-1] = (own[-1][0], first + rows * cols)
            else:
                own.append((first, first + rows * cols))
    for q, spans in groups.items():
        basis = INVERSE[ZIGZAG] * np.frombuffer(q, np.int64)[:, None]
        for a, b in spans:
            for k in range(a, b, 8192):
                x = coefs[k : min(b, k + 8192)].astype(np.float64) @ basis
                x *= 1 / SCALE
                x += 128.5
                np.clip(x, 0, 255, out=x)
                out[k : k + len(x)] = x
    return out


_CHROMA = np.arange(-128, 128)
_RED, _BLUE = (np.rint(c * _CHROMA).astype(np.int16) for c in (1.402, 1.772))
_GREEN = [(np.rint(c * _CHROMA * (1 << 16))).astype(np.int64) for c in (-0.344136, -0.714136)]


def pixels(img: Image, blocks: np.ndarray) -> np.ndarray:
    """height x width x 3 RGB bytes of an image among all samples: chroma is repeated to full size."""
    hm, vm = max(s[0] for s in img.sampling), max(s[1] for s in img.sampling)

    def plane(p: int) -> np.ndarray:
        rows, cols = img.grid(p)
        own = blocks[img.base[p] // 64 : img.base[p] // 64 + rows * cols]
        return own.reshape(rows, cols, 8, 8).swapaxes(1, 2).reshape(rows * 8, cols * 8)

    def full(x: np.ndarray, p: int) -> np.ndarray:
        h, v = img.sampling[p]
        if hm % h or vm % v:
            return x[np.arange(img.height) * v // vm][:, np.arange(img.width) * h // hm]
        x = np.repeat(x, hm // h, axis=1) if hm > h else x
        return (np.repeat(x, vm // v, axis=0) if vm > v else x)[: img.height, : img.width]

    y = full(plane(0), 0)
    if len(img.sampling) == 1:
        return np.repeat(y[:, :, None], 3, axis=2)
    y = y.astype(np.int16)
    cb, cr = plane(1), plane(2)
    out = np.empty((img.height, img.width, 3), np.uint8)
    if cb.shape == cr.shape:
        green = full(((_GREEN[0][cb] + _GREEN[1][cr] + (1 << 15)) >> 16).astype(np.int16), 1)
    else:
        green = ((_GREEN[0][full(cb, 1)] + _GREEN[1][full(cr, 2)] + (1 << 15)) >> 16).astype(np.int16)
    for c, shift in enumerate((full(_RED[cr], 2), green, full(_BLUE[cb], 1))):
        out[:, :, c] = np.clip(y + shift, 0, 255)
    return out


# Encoder ------------------------------------------------------------------------------------------------------------

#: Blocks in a restart interval, bands of coefficients, and the last coefficient of the band that is sent in two steps.
RESTART, TWO_STEPS = 8, 5


def _spec(by_length: dict[int, list[int]]) -> bytes:
    return bytes(len(by_length.get(n, [])) for n in range(1, 17)) + bytes(s for n in range(1, 17) for s in by_length.get(n, []))


DC_SPEC = _spec({4: list(range(12))})
AC_SPEC = _spec({4: list(range(1, 9)), 5: [0], 10: [r << 4 | s for r in range(16) for s in range(16) if r << 4 | s not in range(9) and (0 < s <= 10 or s == 0)]})


def _codes(spec: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = lookup(spec)
    first = np.flatnonzero(np.diff(np.concatenate([[-1], table])) != 0)
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for f in first.tolist():
        n, s = int(table[f]) >> 8, int(table[f]) & 255
        if n:
            code[s], length[s] = f >> (16 - n), n
    return code, length


def _packed(values: np.ndarray, lengths: np.ndarray, lane: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all lanes, each padded with ones to whole bytes, with stuffing; and each lane's end in them. Entries come
    in order of lanes."""
    ends = np.searchsorted(lane, np.arange(lanes), "right")
    sums = np.concatenate([[0], np.cumsum(lengths)])
    size = np.diff(sums[np.concatenate([[0], ends])])
    pad = -size % 8
    begin = np.concatenate([[0], np.cumsum(size + pad)])
    values, lengths = np.insert(values, ends, (1 << pad) - 1), np.insert(lengths, ends, pad)
    at = np.cumsum(lengths) - lengths
    shifted = values.astype(np.uint64) << (64 - (at & 31) - lengths).astype(np.uint64)
    word = at >> 5
    out = np.zeros(int(begin[-1] // 32) + 3, np.uint64)
    heads = np.flatnonzero(word[1:] != word[:-1]) + 1
    heads = np.concatenate([[0], heads]) if len(word) else heads
    if len(heads):
        out[word[heads]] += np.add.reduceat(shifted >> np.uint64(32), heads)
        out[word[heads] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), heads)
    raw = out.astype(">u4").view(np.uint8)[: begin[-1] // 8]
    ff = np.flatnonzero(raw == 0xFF)
    stops = begin[1:] // 8
    return np.insert(raw, ff + 1, 0), stops + np.searchsorted(ff, stops)


def _tables(spec: bytes, symbol_of) -> tuple[np.ndarray, np.ndarray]:
    """Bits and length of code and value, by value + 512."""
    v = np.arange(-512, 513)
    size = np.ceil(np.log2(np.abs(v) + 1.0)).astype(np.int64)
    code, length = _codes(spec)
    s = symbol_of(size)
    return (code[s] << size) | np.where(v < 0, v + (1 << size) - 1, v), length[s] + size


def _encode_dc(v: np.ndarray, lane: np.ndarray, low: int):
    now = v >> low
    diff = np.diff(now, prepend=0)
    heads = np.flatnonzero(np.diff(lane, prepend=-1))
    diff[heads] = now[heads]
    values, lengths = _tables(DC_SPEC, lambda size: size)
    return values[diff + 512], lengths[diff + 512], lane


def _encode_ac(v: np.ndarray, lane: np.ndarray, low: int):
    """First scan of a band: v is blocks x band."""
    now = np.sign(v) * (np.abs(v) >> low) if low else v
    code, length = _codes(AC_SPEC)
    by_value, by_length = _tables(AC_SPEC, lambda size: size)
    n, wide = now.shape
    flat = np.ascontiguousarray(now).ravel()
    hit = np.flatnonzero(flat)
    values, lengths = by_value[flat[hit] + 512], by_length[flat[hit] + 512]
    block = hit // wide
    gap = np.diff(hit, prepend=-1) - 1
    new = np.diff(block, prepend=-1) > 0
    gap[new] = hit[new] % wide  # zeros before a block's first value
    far = np.flatnonzero(gap)
    if len(far):
        value = flat[hit[far]]
        size = np.ceil(np.log2(np.abs(value) + 1.0)).astype(np.int64)
        symbol = (gap[far] % 16) << 4 | size
        values[far] = (code[symbol] << size) | np.where(value < 0, value + (1 << size) - 1, value)
        lengths[far] = length[symbol] + size
    at = lane[block]
    open_ = np.flatnonzero(now[:, -1] == 0)  # ends of bands, after a block's values
    skips = np.repeat(far, gap[far] // 16)  # runs of 16 zeros, before the value
    where = np.concatenate([np.searchsorted(block, open_, "right"), skips])
    extra = np.concatenate([np.zeros(len(open_), np.int64), np.full(len(skips), 0xF0)])
    return np.insert(values, where, code[extra]), np.insert(lengths, where, length[extra]), np.insert(at, where, np.concatenate([lane[open_], at[skips]]))


def _encode_refined(v: np.ndarray, lane: np.ndarray):
    """Last bit of a band of at most 16 coefficients that was sent without it."""
    code, length = _codes(AC_SPEC)
    n, wide = v.shape
    values, lengths = np.zeros((n, wide + 1), np.int64), np.zeros((n, wide + 1), np.int64)
    run, held, count = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(wide):
        size = np.abs(v[:, k])
        old, new = size > 1, size == 1
        symbol = run << 4 | 1
        values[:, k] = np.where(new, (((code[symbol] << 1) | (v[:, k] > 0)) << count) | held, 0)
        lengths[:, k] = np.where(new, length[symbol] + 1 + count, 0)
        held, count = np.where(new, 0, np.where(old, held << 1 | size & 1, held)), np.where(new, 0, count + old)
        run = np.where(new, 0, run + (size == 0))
    rest = (run > 0) | (count > 0)
    values[:, wide] = np.where(rest, code[0] << count | held, 0)
    lengths[:, wide] = np.where(rest, length[0] + count, 0)
    used = lengths.ravel() > 0
    return values.ravel()[used], lengths.ravel()[used], np.repeat(lane, wide + 1)[used]


def _segment(kind: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, kind, len(body) + 2) + body


def encode(coefs: np.ndarray, shapes: list[tuple[int, int]], comments: list[bytes]) -> list[bytes]:
    """Images of coefficients in zigzag order, 4:2:0. shapes: rows and columns of MCUs; an image's blocks are those of
    its luma, row by row, then of both chromas."""
    counts = np.array([(4 * r * c, r * c, r * c) for r, c in shapes]).reshape(-1, 3)
    total = counts.ravel()
    first = np.concatenate([[0], np.cumsum(total)])
    lanes_of = -(-total // RESTART)
    lane_base = np.concatenate([[0], np.cumsum(lanes_of)])
    owner = np.repeat(np.arange(len(total)), total)
    lane = lane_base[owner] + (np.arange(len(coefs)) - first[owner]) // RESTART
    v = coefs.astype(np.int32)
    low_ac, high_ac = v[:, 1 : TWO_STEPS + 1], v[:, TWO_STEPS + 1 :]
    steps = [
        ((0, 0, 0, 1), _encode_dc(v[:, 0], lane, 1)),
        ((1, TWO_STEPS, 0, 1), _encode_ac(low_ac, lane, 1)),
        ((TWO_STEPS + 1, 63, 0, 0), _encode_ac(high_ac, lane, 0)),
        ((0, 0, 1, 0), (v[:, 0] & 1, np.ones(len(v), np.int64), lane)),
        ((1, TWO_STEPS, 1, 0), _encode_refined(low_ac, lane)),
    ]
    packed = [(params, *_packed(*entries, int(lane_base[-1]))) for params, entries in steps]
    head = b"\xff\xd8" + _segment(0xDB, b"\0" + b"\1" * 64) + _segment(0xC4, b"\0" + DC_SPEC) + _segment(0xC4, b"\x10" + AC_SPEC) + _segment(0xDD, struct.pack(">H", RESTART))
    marks = [bytes([0xFF, 0xD0 + k]) for k in range(8)]
    out = []
    for i, ((rows, cols), note) in enumerate(zip(shapes, comments, strict=True)):
        parts = [head, _segment(0xFE, note), _segment(0xC2, struct.pack(">BHHB", 8, rows * 16, cols * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))]
        for (start, end, high, low), data, ends in packed:
            for p in range(3):
                a, b = int(lane_base[3 * i + p]), int(lane_base[3 * i + p + 1])
                parts.append(_segment(0xDA, bytes([1, p + 1, 0, start, end, high << 4 | low])))
                begin = int(ends[a - 1]) if a else 0
                for k in range(a, b):
                    parts.append(data[begin : int(ends[k])].tobytes())
                    begin = int(ends[k])
                    if k < b - 1:
                        parts.append(marks[(k - a) % 8])
        out.append(b"".join(parts) + b"\xff\xd9")
    return out
