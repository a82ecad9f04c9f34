"""Lossless WebP: a decoder of the whole format and the writer of the stored form.

``encode`` writes Huffman codes, back-references, colour cache hits and the transform that the content
asks for, or literals of one width where that takes fewer bytes, as for very short payloads.

The decoder reads prefix codes, back-references and the colour cache, groups of codes, and inverts the
predictor, cross-colour, subtract-green and palette transforms. Streams whose codes all have one length
and hold literals only are decoded at once with numpy; everything else
pixel by pixel.
"""

from __future__ import annotations

import numpy as np

#: Order in which the lengths of the code-length code are stored (fixed values of the format).
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
LENGTH_CODES = 24
DISTANCE_CODES = 40
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
CACHE_FACTOR = 0x1E35A7BD
BLACK = 0xFF000000

#: Neighbours that the short distance codes name: nearest first, then by column, right before left.
NEIGHBOURS = sorted(
    ((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0)
)


class Bits:
    """Bits of a stream, least significant first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def peek(self, n: int) -> int:
        p = self.at >> 3
        return int.from_bytes(self.data[p : p + 8], "little") >> (self.at & 7) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        x = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data):
            raise ValueError("the stream ends early")
        return x


_BITS16 = np.arange(1 << 16, dtype=np.uint32)
#: Every 16-bit number with its bits in reverse.
REVERSED = sum(((_BITS16 >> np.uint32(i)) & np.uint32(1)) << np.uint32(15 - i) for i in range(16)).astype(np.int64)


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols in the order of their codes, and the bits of each."""
    used = np.flatnonzero(lengths)
    order = np.argsort(lengths[used], kind="stable")
    return used[order], lengths[used[order]]


class PrefixCode:
    """A canonical prefix code; one lone symbol takes no bits."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths = np.asarray(lengths, np.int64)
        self.symbols, self.sizes = canonical(lengths)
        self.single = None if len(self.symbols) > 1 else int(self.symbols[0]) if len(self.symbols) else 0
        self.table: list[tuple[int, int]] = [(self.single, 0)] if self.single is not None else []
        self.mask = 0
        if self.single is None and (np.int64(1) << (15 - self.sizes)).sum() != 1 << 15:
            raise ValueError("the code lengths make no prefix code")

    def look(self) -> tuple[list[tuple[int, int]], int]:
        """Table and mask by which a symbol and its bits are read off the next bits of a stream."""
        if not self.table:
            bits = int(self.sizes[-1])
            each = np.int64(1) << (bits - self.sizes)  # rows of a table by the first bit first
            rows = REVERSED[: 1 << bits] >> (16 - bits)
            symbols, sizes = np.repeat(self.symbols, each)[rows], np.repeat(self.sizes, each)[rows]
            self.table, self.mask = list(zip(symbols.tolist(), sizes.tolist(), strict=True)), (1 << bits) - 1
        return self.table, self.mask

    def fixed(self) -> tuple[int, np.ndarray] | None:
        """Length and symbols in order of their codes, if all codes have one length and are byte values."""
        if self.single is not None or self.sizes[0] != self.sizes[-1] or self.symbols[-1] > 255:
            return None
        return int(self.sizes[0]), self.symbols.astype(np.uint8)


def read_code(bits: Bits, size: int) -> PrefixCode:
    if bits.read(1):
        lengths = [0] * size
        two, wide = bits.read(1), bits.read(1)
        lengths[bits.read(8 if wide else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return PrefixCode(lengths)
    of = [0] * 19
    for i in range(4 + bits.read(4)):
        of[LENGTH_ORDER[i]] = bits.read(3)
    code = PrefixCode(of)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    kinds = np.flatnonzero(of)
    if len(kinds) == 2 and kinds[1] < 16 and left >= size:  # one bit a length
        first, skip = bits.at >> 3, bits.at & 7
        raw = np.frombuffer(bits.data[first : first + (skip + size + 7) // 8], np.uint8)
        flat = np.unpackbits(raw, bitorder="little")[skip : skip + size]
        bits.at += size
        if len(flat) < size:
            raise ValueError("the stream ends early")
        return PrefixCode(kinds[flat])
    table, mask = code.look()
    lengths, before = [], 8
    place = bits.at >> 3
    window, have = int.from_bytes(bits.data[place : place + WINDOW], "little") >> (bits.at & 7), 8 * WINDOW - (bits.at & 7)
    place += WINDOW
    while len(lengths) < size and left:
        left -= 1
        if have < 16:
            window |= int.from_bytes(bits.data[place : place + WINDOW], "little") << have
            have += 8 * WINDOW
            place += WINDOW
        s, n = table[window & mask]
        window >>= n
        have -= n
        if s < 16:
            lengths.append(s)
            before = s or before
        elif s == 16:
            lengths += [before] * (3 + (window & 3))
            window >>= 2
            have -= 2
        elif s == 17:
            lengths += [0] * (3 + (window & 7))
            window >>= 3
            have -= 3
        else:
            lengths += [0] * (11 + (window & 127))
            window >>= 7
            have -= 7
    bits.at = 8 * place - have
    if bits.at > 8 * len(bits.data):
        raise ValueError("the stream ends early")
    if len(lengths) > size:
        raise ValueError("too many code lengths")
    return PrefixCode(lengths + [0] * (size - len(lengths)))


#: Extra bits of a length or distance prefix, and the least number it stands for.
EXTENDED = [(0, p + 1) if p < 4 else ((p - 2) >> 1, ((2 + (p & 1)) << ((p - 2) >> 1)) + 1) for p in range(DISTANCE_CODES)]
#: Bytes taken from a stream at once, and more bits than a literal or a reference takes.
WINDOW, LONGEST = 64, 96


def _read_literals(bits: Bits, group: list[PrefixCode], n: int) -> np.ndarray | None:
    """All pixels at once, where every literal takes one number of bits and nothing else can occur."""
    fixed = [c.fixed() for c in group[:4]]
    if any(f is None for f in fixed) or len({f[0] for f in fixed}) > 1:
        return None
    width = fixed[0][0]
    first, skip = bits.at >> 3, bits.at & 7
    count = 4 * n * width
    raw = np.frombuffer(bits.data, np.uint8, min((skip + count + 7) // 8, len(bits.data) - first), first)
    flat = np.unpackbits(raw, bitorder="little")[skip : skip + count]
    if len(flat) < count:
        raise ValueError("the stream ends early")
    code = np.packbits(flat.reshape(-1, width), axis=1, bitorder="big")[:, 0] >> (8 - width)
    code = code.reshape(n, 4)
    green, red, blue, alpha = (fixed[i][1][code[:, i]].astype(np.uint32) for i in range(4))
    bits.at += count
    return alpha << 24 | red << 16 | green << 8 | blue


def read_pixels(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """The ARGB numbers of an entropy-coded image; only the top image may have groups of codes."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    shift, groups_at, n_groups = 0, None, 1
    if top and bits.read(1):
        shift = bits.read(3) + 2
        columns, rows = -(-width // (1 << shift)), -(-height // (1 << shift))
        groups_at = (read_pixels(bits, columns, rows, False) >> 8 & 0xFFFF).reshape(rows, columns).tolist()
        n_groups = max(map(max, groups_at)) + 1
    green = 256 + LENGTH_CODES + (1 << cache_bits if cache_bits else 0)
    groups = [[read_code(bits, size) for size in (green, 256, 256, 256, DISTANCE_CODES)] for _ in range(n_groups)]
    total = width * height
    if groups_at is None and not cache_bits and (quick := _read_literals(bits, groups[0], total)) is not None:
        return quick
    out: list[int] = []
    cache = [0] * (1 << cache_bits) if cache_bits else None
    cached = 0  # pixels that the cache has seen

    looks = [[code.look() for code in group] for group in groups]
    (greens, green_mask), (reds, red_mask), (blues, blue_mask), (alphas, alpha_mask), (fars, far_mask) = looks[0]
    # The stream as one number, of which a window of WINDOW bits is in hand; symbols are cut off its end.
    data, end = bits.data, 8 * len(bits.data)
    place = bits.at >> 3
    window, have = int.from_bytes(data[place : place + WINDOW], "little") >> (bits.at & 7), 8 * WINDOW - (bits.at & 7)
    place += WINDOW
    x = y = 0  # of the next pixel, where groups of codes depend on it
    while len(out) < total:
        if have < LONGEST:
            window |= int.from_bytes(data[place : place + WINDOW], "little") << have
            have += 8 * WINDOW
            place += WINDOW
            if 8 * place - have > end:
                raise ValueError("the stream ends early")
        if groups_at:
            y, x = divmod(len(out), width)
            (greens, green_mask), (reds, red_mask), (blues, blue_mask), (alphas, alpha_mask), (fars, far_mask) = looks[groups_at[y >> shift][x >> shift]]
        s, n = greens[window & green_mask]
        window >>= n
        if s < 256:
            red, i = reds[window & red_mask]
            window >>= i
            blue, j = blues[window & blue_mask]
            window >>= j
            alpha, k = alphas[window & alpha_mask]
            window >>= k
            have -= n + i + j + k
            out.append(alpha << 24 | red << 16 | s << 8 | blue)
        elif s < 256 + LENGTH_CODES:
            extra, base = EXTENDED[s - 256]
            length = base + (window & ((1 << extra) - 1))
            window >>= extra
            prefix, i = fars[window & far_mask]
            window >>= i
            more, base = EXTENDED[prefix]
            d = base + (window & ((1 << more) - 1))
            window >>= more
            have -= n + extra + i + more
            if d > len(NEIGHBOURS):
                d -= len(NEIGHBOURS)
            else:
                dx, dy = NEIGHBOURS[d - 1]
                d = max(1, dx + dy * width)
            if d > len(out) or len(out) + length > total:
                raise ValueError("a back-reference leaves the image")
            if d >= length:
                at = len(out) - d
                out += out[at : at + length]
            else:
                run = out[-d:]
                out += (run * (-(-length // d)))[:length]
        else:
            have -= n
            if cached < len(out):
                for argb in out[cached:]:
                    cache[(CACHE_FACTOR * argb & 0xFFFFFFFF) >> (32 - cache_bits)] = argb
                cached = len(out)
            out.append(cache[s - 256 - LENGTH_CODES])
    bits.at = 8 * place - have
    if bits.at > end:
        raise ValueError("the stream ends early")
    return np.array(out, np.uint32)


def _channels(argb: int) -> tuple[int, int, int, int]:
    return argb >> 24, argb >> 16 & 255, argb >> 8 & 255, argb & 255


def predict(mode: int, left: tuple, top: tuple, corner: tuple, right: tuple) -> tuple:
    """What a predictor mode foretells, by channel; right is the pixel above and to the right."""
    half = lambda a, b: tuple((p + q) >> 1 for p, q in zip(a, b))  # noqa: E731, B905
    clamp = lambda x: min(255, max(0, x))
    if mode == 1:
        return left
    if mode == 2:
        return top
    if mode == 3:
        return right
    if mode == 4:
        return corner
    if mode == 5:
        return half(half(left, right), top)
    if mode == 6:
        return half(left, corner)
    if mode == 7:
        return half(left, top)
    if mode == 8:
        return half(corner, top)
    if mode == 9:
        return half(top, right)
    if mode == 10:
        return half(half(left, corner), half(top, right))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, corner))  # noqa: B905
        to_top = sum(abs(p - c) for p, c in zip(left, corner))  # noqa: B905
        return left if to_left < to_top else top
    if mode == 12:
        return tuple(clamp(p + t - c) for p, t, c in zip(left, top, corner))  # noqa: B905
    if mode == 13:
        return tuple(clamp(a + int((a - c) / 2)) for a, c in zip(half(left, top), corner))  # noqa: B905
    return _channels(BLACK)


def predictions(pixels: list[list[tuple]], modes: list[list[int]], shift: int, x: int, y: int) -> tuple:
    """The prediction for (x, y) from pixels before it, edges included."""
    if not x and not y:
        return _channels(BLACK)
    if not y:
        return pixels[0][x - 1]
    if not x:
        return pixels[y - 1][0]
    above = pixels[y - 1]
    right = above[x + 1] if x + 1 < len(above) else pixels[y][0]
    return predict(modes[y >> shift][x >> shift], pixels[y][x - 1], above[x], above[x - 1], right)


def _undo_predictor(image: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    height, width = image.shape
    kinds = (modes >> 8 & 255).tolist()
    out: list[list[tuple]] = []
    for y, row in enumerate(image.tolist()):
        out.append([])
        for x, argb in enumerate(row):
            p = predictions(out, kinds, shift, x, y)
            out[y].append(tuple((a + b) & 255 for a, b in zip(_channels(argb), p)))  # noqa: B905
    a = np.array(out, np.uint32).reshape(height, width, 4)
    return a[..., 0] << 24 | a[..., 1] << 16 | a[..., 2] << 8 | a[..., 3]


def _split(image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple((image >> s & 255).astype(np.int32) for s in (24, 16, 8, 0))


def _join(a: np.ndarray, r: np.ndarray, g: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = [(c & 255).astype(np.uint32) for c in (a, r, g, b)]
    return x[0] << 24 | x[1] << 16 | x[2] << 8 | x[3]


def colour_delta(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    signed = lambda v: (v & 255) - 256 * ((v & 255) > 127)
    return signed(t) * signed(c) >> 5


def _undo_cross_colour(image: np.ndarray, elements: np.ndarray, shift: int) -> np.ndarray:
    height, width = image.shape
    of = elements[np.arange(height)[:, None] >> shift, np.arange(width)[None, :] >> shift]
    _, red_to_blue, green_to_blue, green_to_red = _split(of)
    a, r, g, b = _split(image)
    r = r + colour_delta(green_to_red, g)
    b = b + colour_delta(green_to_blue, g) + colour_delta(red_to_blue, r)
    return _join(a, r, g, b)


def _undo_subtract_green(image: np.ndarray) -> np.ndarray:
    a, r, g, b = _split(image)
    return _join(a, r + g, g, b + g)


def _undo_palette(image: np.ndarray, palette: np.ndarray, packed: int, width: int) -> np.ndarray:
    index = image >> 8 & 255
    if packed:
        each = 8 >> packed
        at = np.arange(width)
        index = index[:, at >> packed] >> (each * (at & ((1 << packed) - 1))).astype(np.uint32) & ((1 << each) - 1)
    table = np.zeros(256, np.uint32)
    table[: len(palette)] = palette
    return table[index]


def decode_stream(data: bytes) -> np.ndarray:
    """ARGB numbers (height, width) of a lossless bitstream."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("no lossless bitstream")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, now, seen = [], width, set()
    while bits.read(1):
        kind = bits.read(2)
        if kind in seen:
            raise ValueError("a transform occurs twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.read(3) + 2
            columns, rows = -(-now // (1 << shift)), -(-height // (1 << shift))
            part = read_pixels(bits, columns, rows, False).reshape(rows, columns)
            invert = _undo_predictor if kind == PREDICTOR else _undo_cross_colour
            undo.append(lambda image, f=invert, part=part, shift=shift: f(image, part, shift))
        elif kind == SUBTRACT_GREEN:
            undo.append(_undo_subtract_green)
        else:
            size = bits.read(8) + 1
            deltas = _split(read_pixels(bits, size, 1, False))
            palette = _join(*(np.cumsum(d) for d in deltas))
            packed = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            undo.append(lambda image, p=palette, k=packed, w=now: _undo_palette(image, p, k, w))
            now = -(-now // (1 << packed))
    image = read_pixels(bits, now, height, True).reshape(height, now)
    for f in reversed(undo):
        image = f(image)
    return image


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Samples (height, width, RGBA) of the first file in ``data``, and where it ends."""
    if data[:4] != b"RIFF" or data[8:16] != b"WEBPVP8L":
        raise ValueError("no lossless WebP file")
    size, chunk = int.from_bytes(data[4:8], "little"), int.from_bytes(data[16:20], "little")
    a, r, g, b = _split(decode_stream(data[20 : 20 + chunk]))
    return np.stack([r, g, b, a], -1).astype(np.uint8), 8 + size


class Writer:
    """Bits into bytes, least significant first."""

    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, x: int, n: int) -> None:
        self.value |= x << self.n
        self.n += n


def _put_fixed_code(out: Writer, symbols: np.ndarray, width: int, size: int) -> None:
    """A code in which ``symbols`` have ``width`` bits each, and nothing else occurs."""
    out.put(0, 1)
    all_bytes = len(symbols) == 256
    used = {width} if all_bytes else {0, width}
    n = max(LENGTH_ORDER.index(x) for x in used) + 1
    n = max(n, 4)
    out.put(n - 4, 4)
    for i in range(n):
        out.put(int(LENGTH_ORDER[i] in used), 3)
    if all_bytes:
        if size == 256:
            out.put(0, 1)
        else:  # 256 lengths follow
            out.put(1, 1)
            out.put(3, 3)
            out.put(256 - 2, 8)
        return
    out.put(0, 1)
    has = np.zeros(size, bool)
    has[symbols] = True
    out.put(int.from_bytes(np.packbits(has, bitorder="little").tobytes(), "little"), size)


def _encode_fixed(samples: np.ndarray) -> bytes:
    """A stream of samples (height, width, RGBA) as literals of one width.

    All four channels share one code, in which every sample takes as many bits as the number of
    different samples needs; the symbols of a partly used code are filled up.
    """
    height, width, _ = samples.shape
    flat = samples.reshape(-1, 4)[:, [1, 0, 2, 3]].ravel()
    has = np.zeros(256, bool)
    has[flat] = True
    n_bits = max(1, int(has.sum() - 1).bit_length())
    if n_bits < 8 and len(flat) * (8 - n_bits) < 1400:  # a list of symbols would cost more than it saves
        n_bits = 8
    spare = (1 << n_bits) - int(has.sum())
    has[np.flatnonzero(~has)[:spare]] = True
    symbols = np.flatnonzero(has)
    head = Writer()
    head.put(0x2F, 8)
    head.put(width - 1, 14)
    head.put(height - 1, 14)
    head.put(1, 1)
    head.put(0, 3)
    head.put(0, 1)  # no transform
    head.put(0, 1)  # no colour cache
    head.put(0, 1)  # one group of codes
    for size in (256 + LENGTH_CODES, 256, 256, 256):
        _put_fixed_code(head, symbols, n_bits, size)
    head.put(1, 1)  # distances: the one symbol 0
    head.put(0, 3)
    code = np.zeros(256, np.uint8)
    code[symbols] = np.arange(len(symbols))
    lead = np.unpackbits(np.frombuffer(head.value.to_bytes(-(-head.n // 8), "little"), np.uint8), bitorder="little")[: head.n]
    body = np.unpackbits(code[flat][:, None], axis=1, bitorder="big")[:, 8 - n_bits :].ravel()
    return np.packbits(np.concatenate([lead, body]), bitorder="little").tobytes()


#: More than all weights together.
END = 1 << 62


def code_lengths(counts: np.ndarray, limit: int) -> list[int]:
    """Lengths of a Huffman code of the symbols that occur, none over ``limit``; a lone one has 1."""
    lengths, used = [0] * len(counts), np.flatnonzero(counts).tolist()
    weights = [int(counts[s]) for s in used]
    if len(used) < 2:
        lengths[used[0] if used else 0] = 1
        return lengths
    while True:
        # Leaves by weight; sums come in order of weight by themselves, so that two rows need no heap.
        n = len(used)
        order = sorted(range(n), key=weights.__getitem__)
        light = [weights[k] for k in order]
        light.append(END)
        parent, sums, i, j = [0] * (2 * n - 1), [END] * n, 0, 0
        for k in range(n - 1):
            if light[i] <= sums[j]:
                x, a = light[i], order[i]
                i += 1
            else:
                x, a = sums[j], n + j
                j += 1
            if light[i] <= sums[j]:
                y, b = light[i], order[i]
                i += 1
            else:
                y, b = sums[j], n + j
                j += 1
            parent[a] = parent[b] = n + k
            sums[k] = x + y
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth) <= limit:
            break
        weights = [(w + 1) // 2 for w in weights]
    for k, s in enumerate(used):
        lengths[s] = depth[k]
    return lengths


def _codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every symbol in stream order, and its bits; a lone symbol takes none."""
    value, bits = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    symbols, sizes = canonical(np.asarray(lengths, np.int64))
    if len(symbols) > 1:
        part = np.int64(1) << (16 - sizes)  # of all 16-bit numbers
        value[symbols] = REVERSED[np.cumsum(part) - part]
        bits[symbols] = sizes
    return value, bits


def _runs(lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """Code lengths as symbols of their own code, each with extra bits and their number."""
    ends = [*(np.flatnonzero(lengths[1:] != lengths[:-1]) + 1).tolist(), len(lengths)]
    runs, at = [], 0
    for v, end in zip(lengths[[e - 1 for e in ends]].tolist(), ends, strict=True):
        n, at = end - at, end
        if v:
            runs.append((v, 0, 0))
            if n == 1:
                continue
            n -= 1
        while n >= 3:
            k = min(n, 6 if v else 138)
            runs.append((16, k - 3, 2) if v else (18, k - 11, 7) if k >= 11 else (17, k - 3, 3))
            n -= k
        runs += [(v, 0, 0)] * n
    return runs


#: The longest code the writer gives a symbol, so that tables stay short.
WRITTEN_BITS = 11


def _put_code(out: Writer, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Write a Huffman code for symbols of these counts; its codes and their bits."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 2 and used.max(initial=0) < 256:
        two, first = len(used) == 2, int(used[0]) if len(used) else 0
        out.put(1 | int(two) << 1 | int(first > 1) << 2, 3)
        out.put(first, 8 if first > 1 else 1)
        if two:
            out.put(int(used[1]), 8)
        lengths[used if len(used) else 0] = 1
        return _codes(lengths)
    lengths = np.asarray(code_lengths(counts, WRITTEN_BITS), np.int64)
    out.put(0, 1)
    runs = _runs(lengths)
    of = code_lengths(np.bincount([k for k, _, _ in runs], minlength=19), 7)
    last = max(k for k in range(19) if of[LENGTH_ORDER[k]])
    last = max(last + 1, 4)
    out.put(last - 4, 4)
    head, at = 0, 0
    for k in LENGTH_ORDER[:last]:
        head |= of[k] << at
        at += 3
    value, bits = (x.tolist() for x in _codes(of))
    at += 1  # lengths of all symbols follow
    for k, extra, n in runs:
        head |= (value[k] | extra << bits[k]) << at
        at += bits[k] + n
    out.put(head, at)
    return _codes(lengths)


def _prefix(v: int) -> tuple[int, int, int]:
    """Prefix, extra bits and their count of a length or distance."""
    v -= 1
    if v < 4:
        return v, 0, 0
    k = v.bit_length() - 1
    return 2 * k + (v >> (k - 1) & 1), v & ((1 << (k - 1)) - 1), k - 1


def _cost(counts: np.ndarray) -> float:
    """Bits that symbols of these counts take, with their code."""
    c = counts[counts.nonzero()[0]]
    return float(c @ np.log2(c.sum() / c)) + 5 * len(c)


_CHANNELS = (np.arange(4) * 256).astype(np.int64)


def _literal_cost(image: np.ndarray) -> float:
    """Bits of all pixels as literals, with the codes of the four channels."""
    samples = image.ravel().view(np.uint8).reshape(-1, 4)
    c = np.bincount((samples + _CHANNELS).ravel(), minlength=1024)
    c = c[c > 0]
    return 4 * image.size * float(np.log2(image.size)) - float((c * np.log2(c)).sum()) + 5 * len(c)


def _copies(argb: list[int]) -> list[tuple[int, int, int]]:
    """(at, length, distance) of back-references, each the longest from the last place of its three pixels."""
    out, last, i, n = [], {}, 0, len(argb)
    while i < n - 2:
        key = (argb[i], argb[i + 1], argb[i + 2])
        j = last.get(key)
        last[key] = i
        if j is None:
            i += 1
            continue
        end = min(n, i + 4096)
        k = i + 3
        while k < end and argb[k] == argb[k - i + j]:
            k += 1
        out.append((i, k - i, i - j))
        for m in range(i + 1, min(k, n - 2)):
            last[argb[m], argb[m + 1], argb[m + 2]] = m
        i = k
    return out


CACHE_SIZES = (0, 6, 10)


def _cache_hits(argb: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every pixel, and whether the cache holds it there when its turn comes."""
    slot = (np.uint64(CACHE_FACTOR) * argb.astype(np.uint64) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - bits)
    order = np.argsort(slot, kind="stable")
    hit = np.zeros(len(argb), bool)
    hit[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (argb[order[1:]] == argb[order[:-1]])
    return slot.astype(np.int64), hit


def _put_image(out: Writer, image: np.ndarray, top: bool) -> np.ndarray:
    """Write the head of an entropy-coded image; the bits of its pixels."""
    width, argb = image.shape[1], image.ravel()
    copies = _copies(argb.tolist())
    literal = np.ones(len(argb), bool)
    for at, n, _ in copies:
        literal[at : at + n] = False
    at = np.flatnonzero(literal)
    near: dict[int, int] = {}
    for k, (x, y) in enumerate(NEIGHBOURS):
        near.setdefault(max(1, x + y * width), k + 1)
    lengths = [_prefix(n) for _, n, _ in copies]
    distances = [_prefix(near.get(d, d + len(NEIGHBOURS))) for _, _, d in copies]
    references = np.bincount([256 + p for p, _, _ in lengths] or [0], minlength=256 + LENGTH_CODES) * bool(copies)
    best = None
    for bits in CACHE_SIZES:
        slot, hit = _cache_hits(argb, bits) if bits else (None, np.zeros(len(argb), bool))
        plain, hits = argb[at[~hit[at]]], at[hit[at]]
        a, r, g, b = (np.bincount(c, minlength=256) for c in _split(plain))
        green = np.zeros(256 + LENGTH_CODES + (1 << bits if bits else 0), np.int64)
        green[: 256 + LENGTH_CODES] = references
        green[:256] += g
        if bits:
            green[256 + LENGTH_CODES :] = np.bincount(slot[hits], minlength=1 << bits)
        cost = sum(map(_cost, (green, r, b, a)))
        if best is None or cost < best[0]:
            best = cost, bits, slot, hit, (green, r, b, a)
    _, bits, slot, hit, counts = best
    out.put(int(bits > 0), 1)
    if bits:
        out.put(bits, 4)
    if top:
        out.put(0, 1)  # one group of codes
    codes = [_put_code(out, c) for c in counts]
    codes.append(_put_code(out, np.bincount([p for p, _, _ in distances] or [0], minlength=DISTANCE_CODES)))
    # Four parts a literal or reference, one row a pixel; rows inside references stay empty.
    value, size = np.zeros((len(argb), 4), np.int64), np.zeros((len(argb), 4), np.int64)
    plain, hits = at[~hit[at]], at[hit[at]]
    a, r, g, b = _split(argb[plain])
    for k, c in enumerate((g, r, b, a)):
        value[plain, k], size[plain, k] = codes[k][0][c], codes[k][1][c]
    if len(hits):
        symbol = 256 + LENGTH_CODES + slot[hits]
        value[hits, 0], size[hits, 0] = codes[0][0][symbol], codes[0][1][symbol]
    for (i, _, _), (p, x, n), (q, y, m) in zip(copies, lengths, distances, strict=True):
        value[i] = codes[0][0][256 + p], x, codes[4][0][q], y
        size[i] = codes[0][1][256 + p], n, codes[4][1][q], m
    value, size = value.ravel(), size.ravel()
    offset = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return (np.repeat(value, size) >> offset & 1).astype(np.uint8)


def _put_part(out: Writer, image: np.ndarray) -> None:
    """Write the whole image of a transform's data."""
    flat = _put_image(out, image, False)
    out.put(int.from_bytes(np.packbits(flat, bitorder="little").tobytes(), "little"), len(flat))


def _transforms(image: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray | int | None]]:
    """Transforms that might pay: kind, the image after it, and its data."""
    samples = np.ascontiguousarray(image).view(np.uint8).reshape(*image.shape, 4)  # blue, green, red, alpha
    whole = lambda x: np.ascontiguousarray(x).view(np.uint32).reshape(image.shape)
    less = samples.copy()
    less[..., 0] -= samples[..., 1]
    less[..., 2] -= samples[..., 1]
    out = [(SUBTRACT_GREEN, whole(less), None)]
    for mode in (1, 2):
        before = np.zeros_like(samples)
        before[0, 0, 3] = 255
        if mode == 1:
            before[:, 1:] = samples[:, :-1]
            before[1:, 0] = samples[:-1, 0]
        else:
            before[0, 1:] = samples[0, :-1]
            before[1:] = samples[:-1]
        out.append((PREDICTOR, whole(samples - before), mode))
    a, r, g, b = _split(image)
    signed = lambda c: (c - 256 * (c > 127)).astype(np.float64)
    x = signed(g) - signed(g).mean()
    slopes = [int(np.clip(np.rint(32 * (x * signed(c)).sum() / max(1.0, (x * x).sum())), -128, 127)) for c in (r, b)]
    to_red, to_blue = slopes
    element = np.uint32(BLACK | (to_blue & 255) << 8 | to_red & 255)
    deltas = [colour_delta(np.int32(t), g) for t in slopes]
    out.append((CROSS_COLOUR, _join(a, r - deltas[0], g, b - deltas[1]), element))
    colours = np.unique(image)
    if len(colours) <= 256:
        k = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
        index = np.searchsorted(colours, image).astype(np.uint32)
        width = image.shape[1]
        packed = np.zeros((len(image), -(-width // (1 << k))), np.uint32)
        for i in range(width):
            packed[:, i >> k] |= index[:, i] << np.uint32((8 >> k) * (i & ((1 << k) - 1)))
        out.append((PALETTE, np.uint32(BLACK) | packed << np.uint32(8), colours))
    return out


def _encode_entropy(samples: np.ndarray) -> bytes:
    """A stream of samples with the transform, references, cache and codes that suit them."""
    height, width, _ = samples.shape
    r, g, b, a = (samples[..., k].astype(np.int32) for k in range(4))
    image = _join(a, r, g, b)
    out = Writer()
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    options = [(_literal_cost(now) + 32 * (len(data) if kind == PALETTE else 1), kind, now, data) for kind, now, data in _transforms(image)]
    cost, kind, now, data = min(options, key=lambda o: o[0])
    if cost < _literal_cost(image):
        image = now
        out.put(1, 1)
        out.put(kind, 2)
        if kind == PALETTE:
            out.put(len(data) - 1, 8)
            deltas = _join(*(np.diff(c, prepend=0) for c in _split(data)))
            _put_part(out, deltas[None, :])
        elif kind != SUBTRACT_GREEN:
            out.put(7, 3)
            value = np.uint32(BLACK | data << 8) if kind == PREDICTOR else data
            _put_part(out, np.full((-(-height // 512), -(-width // 512)), value, np.uint32))
    out.put(0, 1)
    body = _put_image(out, image, True)
    lead = np.unpackbits(np.frombuffer(out.value.to_bytes(-(-out.n // 8), "little"), np.uint8), bitorder="little")[: out.n]
    return np.packbits(np.concatenate([lead, body]), bitorder="little").tobytes()


def encode(samples: np.ndarray) -> bytes:
    """A lossless WebP file of samples (height, width, RGBA), in the smaller of the two ways to write it."""
    stream = _encode_entropy(samples)
    width = max(1, int(np.count_nonzero(np.bincount(samples.ravel(), minlength=256)) - 1).bit_length())
    if samples.size * width < 8 * len(stream):  # what its literals take alone
        stream = min(stream, _encode_fixed(samples), key=len)
    padded = stream + b"\0" * (len(stream) & 1)
    chunk = b"VP8L" + len(stream).to_bytes(4, "little") + padded
    return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk
