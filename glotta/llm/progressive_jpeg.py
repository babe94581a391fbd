"""Progressive JPEG as a lossless container of bytes, and a progressive decoder.

*Writing.*  Each payload byte becomes one quantized coefficient (the format's
unit): byte b is the value of category 8 whose eight extra bits are b, so all
values lie in -255..-128 or 128..255.  Blocks of 64 fill a 4:2:0 image, the
luma blocks first.  Ten scans carry them: DC and two AC bands of each component
without their lowest bit (spectral selection and successive approximation),
then the lowest bits.  A comment segment holds the payload's length.

*Reading.*  Scans accumulate in coefficient arrays.  Entropy-coded data is
decoded with numpy: a table over every bit position's next 16 bits gives symbol
and step, and a walk over the steps picks the true positions; a scan with one
fixed step, or one whose coefficients are all refined, needs no walk.  Other
streams take a general path, bit by bit.  DC scans may interleave components, as
most encoders write them, and scans may hold restart markers.  The inverse transform is one matrix
product; chroma is upsampled by repetition; the result is an RGB tensor of full
resolution.

Edge cases: null or empty text is one padded unit of 576 bytes; equal texts
have equal media, payloads and features; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, flat_bytes, plain, ship, text_slices

UNIT = 576
PAD = 255
_MARK = b"payload="


def _zigzag() -> np.ndarray:
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


ZIGZAG = _zigzag()


def _basis() -> np.ndarray:
    """Coefficients in zigzag order times this are the block's samples."""
    x = np.arange(8)
    c = np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) * np.where(x == 0, np.sqrt(1 / 8), 0.5)[:, None]
    return np.einsum("ux,vy->uvxy", c, c).reshape(64, 64)[ZIGZAG].astype(np.float32)


_BASIS = _basis()


# ---------------------------------------------------------------- segments


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, slot: int, lengths: dict[int, list[int]]) -> bytes:
    counts = bytes(len(lengths.get(i, [])) for i in range(1, 17))
    return _segment(0xC4, bytes([kind << 4 | slot]) + counts + bytes(s for i in sorted(lengths) for s in lengths[i]))


#: DC categories and end-of-band runs have 4-bit codes; the AC scans know one
#: symbol, "no zeros before, category 7", of one bit.
_TABLES = _huffman(0, 0, {4: list(range(12))}) + _huffman(1, 0, {1: [0x07]}) + _huffman(1, 1, {4: [r << 4 for r in range(15)]})


def _stuffed(data: np.ndarray) -> bytes:
    return data.tobytes().replace(b"\xff", b"\xff\x00")


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits as bytes, the last one filled with ones."""
    out = np.packbits(bits)
    if len(bits) % 8:
        out[-1] |= (1 << (8 - len(bits) % 8)) - 1
    return out


def _codes(value: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bits of codes of various lengths, one after the other."""
    owner = np.repeat(np.arange(len(value)), length)
    place = np.repeat(np.cumsum(length), length) - 1 - np.arange(len(owner))
    return (value[owner] >> place & 1).astype(np.uint8)


def _scan(component: int, tables: int, first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    return _segment(0xDA, bytes([1, component, tables, first, last, high << 4 | low])) + data


_CATEGORY = np.zeros(1024, np.int64)
for _i in range(1, 1024):
    _CATEGORY[_i] = _i.bit_length()


def geometry(blocks: int) -> tuple[int, int]:
    """Columns and rows of MCUs (six blocks each) for so many blocks."""
    units = max(1, -(-blocks // 6))
    wide = min(4095, max(1, int(units**0.5)))
    return wide, -(-units // wide)


def encode(payload: bytes | np.ndarray) -> bytes:
    p = np.frombuffer(payload, np.uint8) if isinstance(payload, bytes) else payload
    wide, high = geometry(-(-len(p) // 64))
    units = wide * high
    full = np.full(units * 384, PAD, np.uint8)
    full[: len(p)] = p
    blocks = full.reshape(-1, 64)
    out = [b"\xff\xd8", _segment(0xFE, _MARK + str(len(p)).encode()), _segment(0xDB, b"\x00" + b"\x01" * 64)]
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])))
    out.append(_TABLES)
    parts = ((1, blocks[: 4 * units]), (2, blocks[4 * units : 5 * units]), (3, blocks[5 * units :]))
    for c, b in parts:
        dc = b[:, 0].astype(np.int64)
        dc = np.where(dc < 128, dc - 255, dc) >> 1
        step = np.diff(dc, prepend=0)
        size = _CATEGORY[np.abs(step)]
        extra = np.where(step < 0, step + (1 << size) - 1, step)
        out.append(_scan(c, 0x00, 0, 0, 0, 1, _stuffed(_packed(_codes(size << size | extra, 4 + size)))))
    for c, b in parts:
        half = b >> 1  # the one code, 0, and seven extra bits
        out.append(_scan(c, 0x00, 1, 5, 0, 1, half[:, 1:6].tobytes()))
        out.append(_scan(c, 0x00, 6, 63, 0, 1, half[:, 6:].tobytes()))
    for c, b in parts:
        # the lowest bit: of the value for DC, of the magnitude for AC
        odd = (b & 1) ^ (b < 128)
        out.append(_scan(c, 0x00, 0, 0, 1, 0, _stuffed(_packed(odd[:, 0]))))
        bits = []
        for at in range(0, len(b), 32767):
            n = min(32767, len(b) - at)
            r = n.bit_length() - 1
            bits.append(np.array([int(x) for x in f"{r:04b}"] + [int(x) for x in bin(n)[3:]], np.uint8))
            bits.append(odd[at : at + n, 1:].ravel())
        out.append(_scan(c, 0x01, 1, 63, 1, 0, _stuffed(_packed(np.concatenate(bits)))))
    out.append(b"\xff\xd9")
    return b"".join(out)


# ------------------------------------------------------------------ reading


class Code:
    """A Huffman table over the next 16 bits."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.symbol, self.length = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
        code, k = 0, 0
        for size in range(1, 17):
            for _ in range(counts[size - 1]):
                a, b = code << (16 - size), (code + 1) << (16 - size)
                self.symbol[a:b], self.length[a:b] = symbols[k], size
                code, k = code + 1, k + 1
            code <<= 1
        self.only = symbols[0] if len(symbols) == 1 and counts[0] == 1 else None


class Bits:
    """Entropy-coded data, one bit at a time."""

    def __init__(self, data: np.ndarray):
        self.data, self.at = np.concatenate([data, np.full(4, 255, np.uint8)]), 0
        self.end = len(data) * 8

    def peek(self) -> int:
        i, j = self.at >> 3, self.at & 7
        a, b, c = (int(x) for x in self.data[i : i + 3])
        return ((a << 16 | b << 8 | c) >> (8 - j)) & 0xFFFF

    def symbol(self, code: Code) -> int:
        k = self.peek()
        n = int(code.length[k])
        if not n or self.at + n > self.end:
            raise ValueError("the scan ends early or holds an unknown code")
        self.at += n
        return int(code.symbol[k])

    def take(self, n: int) -> int:
        out = 0
        for _ in range(n):
            out = out << 1 | (int(self.data[self.at >> 3]) >> (7 - (self.at & 7)) & 1)
            self.at += 1
        return out

    def many(self, n: int) -> np.ndarray:
        i, j = self.at >> 3, self.at & 7
        out = np.unpackbits(self.data[i : i + (j + n + 7) // 8])[j : j + n]
        self.at += n
        return out


def _extended(extra: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(extra < (1 << size >> 1), extra - (1 << size) + 1, extra)


def _dc_steps(data: np.ndarray, codes: list[Code], n: int) -> np.ndarray:
    """n DC differences, whose codes take turns: table every bit position for
    each code, and walk the steps."""
    padded = np.concatenate([data, np.full(4, 255, np.uint8)]).astype(np.uint32)
    word = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    peek = (word[:, None] >> (16 - np.arange(8, dtype=np.uint32))[None, :] & 0xFFFF).ravel()
    steps = {id(c): (c.length[peek] + c.symbol[peek].astype(np.int64)).tolist() for c in codes}
    turn = [steps[id(c)] for c in codes]
    at, end, where = 0, len(data) * 8, []
    for i in range(n):
        where.append(at)
        step = turn[i % len(turn)]
        if at >= end or not step[at]:
            raise ValueError("the scan ends early or holds an unknown code")
        at += step[at]
    pos, out = np.array(where, np.int64), np.zeros(n, np.int64)
    for k, code in enumerate(codes):
        p = pos[k :: len(codes)]
        size = code.symbol[peek[p]].astype(np.int64)
        p = p + code.length[peek[p]]
        wide = (word[np.minimum(p >> 3, len(word) - 1)].astype(np.int64) << (p & 7) & 0xFFFFFFFF) >> (32 - size)
        out[k :: len(codes)] = _extended(wide, size)
    return out


def _ac_first(bits: Bits, code: Code, block: np.ndarray, first: int, last: int, low: int) -> None:
    width = last - first + 1
    if code.only is not None and code.only & 15 and code.only >> 4 == 0:
        size = code.only & 15
        if len(block) * width * (1 + size) <= bits.end:
            if size == 7:
                extra = bits.data[: len(block) * width].astype(np.int16)
            else:
                raw = bits.many(len(block) * width * (1 + size)).reshape(-1, 1 + size)[:, 1:]
                extra = raw @ (1 << np.arange(size - 1, -1, -1)).astype(np.int16)
            value = np.where(extra < (1 << size - 1), extra - ((1 << size) - 1), extra)
            block[:, first : last + 1] = (value << low).reshape(-1, width)
            return
    run = 0
    for b in block:
        if run:
            run -= 1
            continue
        k = first
        while k <= last:
            s = bits.symbol(code)
            r, size = s >> 4, s & 15
            if size:
                k += r
                extra = bits.take(size)
                b[k] = (extra if extra >> (size - 1) else extra - (1 << size) + 1) << low
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) + bits.take(r) - 1
                break


def _ac_refine(bits: Bits, code: Code, block: np.ndarray, first: int, last: int, low: int) -> None:
    one, band = 1 << low, block[:, first : last + 1]
    dense = bool((band != 0).all())
    i = 0
    while i < len(band):
        b, k, new = band[i], 0, None
        while k < band.shape[1]:
            s = bits.symbol(code)
            r, size = s >> 4, s & 15
            if size == 0 and r < 15:
                run = (1 << r) + bits.take(r)
                rest = band[i, k:]
                seen = np.flatnonzero(rest)
                rest[seen] += np.where(bits.many(len(seen)) > 0, np.where(rest[seen] > 0, one, -one), 0).astype(band.dtype)
                if dense and run > 1:
                    part = band[i + 1 : i + run]
                    fix = bits.many(part.size).reshape(part.shape).astype(band.dtype)
                    part += np.where(part > 0, fix, -fix) * band.dtype.type(one)
                else:
                    for part in band[i + 1 : i + run]:
                        seen = np.flatnonzero(part)
                        part[seen] += np.where(bits.many(len(seen)) > 0, np.where(part[seen] > 0, one, -one), 0).astype(band.dtype)
                i += run - 1
                break
            new = (one if bits.take(1) else -one) if size else None
            while k < band.shape[1]:
                if b[k]:
                    if bits.take(1):
                        b[k] += one if b[k] > 0 else -one
                elif r:
                    r -= 1
                else:
                    if new is not None:
                        b[k] = new
                    k += 1
                    break
                k += 1
        i += 1


class Image:
    """Coefficients of a progressive JPEG, and what it says of itself."""

    def __init__(self, raw: bytes):
        self.comment = b""
        codes: dict[int, Code] = {}
        self.restart, self.ycc = 0, True
        self.tables: dict[int, np.ndarray] = {}
        at = 2
        if raw[:2] != b"\xff\xd8":
            raise ValueError("no JPEG")
        while True:
            if raw[at] != 0xFF:
                raise ValueError("a marker is missing")
            while raw[at + 1] == 0xFF:  # fill bytes
                at += 1
            marker = raw[at + 1]
            if marker == 0xD9:
                return
            size = raw[at + 2] << 8 | raw[at + 3]
            body = raw[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.tables[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float32)
                    body = body[65 + 64 * wide :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    codes[body[0]] = _code(body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xC2:
                self._frame(body)
            elif marker in (0xC0, 0xC1, *range(0xC3, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
                raise ValueError("only progressive frames are read")
            elif marker == 0xDD:
                self.restart = body[0] << 8 | body[1]
            elif marker == 0xEE and body.startswith(b"Adobe") and len(body) > 11:
                self.ycc = body[11] > 0
            elif marker == 0xDA:
                parts, end = [], at
                while True:
                    end = raw.find(b"\xff", end)
                    if end < 0 or end + 1 >= len(raw):
                        raise ValueError("the last scan has no end")
                    if 0xD0 <= raw[end + 1] <= 0xD7:  # a restart
                        parts.append(raw[at:end])
                        at = end + 2
                    elif raw[end + 1]:
                        break
                    end += 2
                parts.append(raw[at:end])
                data = [np.frombuffer(p.replace(b"\xff\x00", b"\xff"), np.uint8) for p in parts]
                self._scan(body, data, codes)
                at = end

    def _frame(self, body: bytes) -> None:
        _, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        self.parts = {}
        spec = [body[6 + 3 * i : 9 + 3 * i] for i in range(n)]
        self.most = max(s[1] >> 4 for s in spec), max(s[1] & 15 for s in spec)
        self.units = -(-self.width // (8 * self.most[0])), -(-self.height // (8 * self.most[1]))
        if n not in (1, 3):
            raise ValueError("only images of one or three components are read")
        for c, hv, q in spec:
            h, v = hv >> 4, hv & 15
            self.parts[c] = (h, v, q, np.zeros((self.units[0] * h * self.units[1] * v, 64), np.int16))

    def _scan(self, body: bytes, data: list[np.ndarray], codes: dict[int, Code]) -> None:
        """``data`` has a part for each restart interval."""
        n = body[0]
        spec = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(n)]
        first, last, bits = body[1 + 2 * n : 4 + 2 * n]
        high, low = bits >> 4, bits & 15
        if n > 1:
            if first or last:
                raise ValueError("only DC scans interleave components")
            self._interleaved(spec, high, low, data, codes)
            return
        c, tables = spec[0]
        h, v, _, block = self.parts[c]
        # a scan of one component has only the blocks that the image needs
        wide, tall = -(-(-(-self.width * h // self.most[0])) // 8), -(-(-(-self.height * v // self.most[1])) // 8)
        all_ = wide * tall == len(block)
        some = block if all_ else block.reshape(self.units[1] * v, self.units[0] * h, 64)[:tall, :wide].reshape(-1, 64)
        step = self.restart or len(some)
        for i, part in enumerate(data):
            blocks = some[i * step : (i + 1) * step]
            if first == 0 and high == 0:
                blocks[:, 0] = np.cumsum(_dc_steps(part, [codes[tables >> 4]], len(blocks))) << low
            elif first == 0:
                blocks[:, 0] |= np.unpackbits(part)[: len(blocks)].astype(np.int16) << low
            elif high == 0:
                _ac_first(Bits(part), codes[0x10 | tables & 15], blocks, first, last, low)
            else:
                _ac_refine(Bits(part), codes[0x10 | tables & 15], blocks, first, last, low)
        if not all_:
            block.reshape(self.units[1] * v, self.units[0] * h, 64)[:tall, :wide] = some.reshape(tall, wide, 64)

    def _interleaved(self, spec: list[tuple[int, int]], high: int, low: int, data: list[np.ndarray], codes: dict[int, Code]) -> None:
        """DC values of several components, unit by unit."""
        turns, where = [], []
        for c, tables in spec:
            h, v, _, block = self.parts[c]
            place = np.arange(len(block)).reshape(self.units[1], v, self.units[0], h).transpose(0, 2, 1, 3).reshape(-1, h * v)
            where.append(place)
            turns += [codes.get(tables >> 4)] * (h * v)
        units = self.units[0] * self.units[1]
        step = self.restart or units
        for i, part in enumerate(data):
            some = slice(i * step, min(units, (i + 1) * step))
            n = (some.stop - some.start) * len(turns)
            values = (_dc_steps(part, turns, n) if high == 0 else np.unpackbits(part)[:n].astype(np.int64)).reshape(-1, len(turns))
            at = 0
            for (c, _), place in zip(spec, where, strict=True):
                block, mine = self.parts[c][3], values[:, at : at + place.shape[1]]
                at += place.shape[1]
                if high == 0:
                    block[place[some].ravel(), 0] = np.cumsum(mine.ravel()) << low
                else:
                    block[place[some].ravel(), 0] |= (mine.ravel() << low).astype(np.int16)

    def payload(self) -> bytes:
        if not self.comment.startswith(_MARK):
            raise ValueError("no payload")
        every = np.concatenate([p[3] for p in self.parts.values()]).ravel()
        return np.where(every < 0, every + 255, every).astype(np.uint8)[: int(self.comment[len(_MARK) :])].tobytes()

    def rgb(self) -> np.ndarray:
        """(height, width, 3) samples at full resolution."""
        planes = []
        for h, v, q, block in self.parts.values():
            wide, tall = self.units[0] * h, self.units[1] * v
            x = (block.astype(np.float32) @ (_BASIS * self.tables[q][:, None])).reshape(tall, wide, 8, 8).transpose(0, 2, 1, 3).reshape(tall * 8, wide * 8)
            fx, fy = self.most[0] // h, self.most[1] // v
            if fx > 1 or fy > 1:
                x = np.broadcast_to(x[:, None, :, None], (x.shape[0], fy, x.shape[1], fx)).reshape(x.shape[0] * fy, x.shape[1] * fx)
            planes.append(x)
        out = np.empty((*planes[0].shape, 3), np.uint8)
        y = planes[0] + np.float32(128.5)
        if len(planes) == 1:
            out[:] = np.clip(y, 0, 255)[:, :, None]
        elif not self.ycc:
            for i, p in enumerate(planes):
                out[:, :, i] = np.clip(p + np.float32(128.5), 0, 255)
        else:
            cb, cr = planes[1:]
            for i, p in enumerate((y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb)):
                out[:, :, i] = np.clip(p, 0, 255, out=p)
        return out[: self.height, : self.width]


_CODES: dict[tuple[bytes, bytes], Code] = {}


def _code(counts: bytes, symbols: bytes) -> Code:
    if (counts, symbols) not in _CODES:
        if len(_CODES) > 64:
            _CODES.clear()
        _CODES[counts, symbols] = Code(counts, symbols)
    return _CODES[counts, symbols]


# ---------------------------------------------------------------- operators


def padded(data: np.ndarray, unit: int = UNIT) -> np.ndarray:
    n = max(1, -(-len(data) // unit)) * unit
    out = np.full(n, PAD, np.uint8)
    out[: len(data)] = data
    return out


_MEDIA = pa.schema([("row_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])


def _encode(batches):
    for b in text_slices(batches, 1, 4 << 20):
        buf, offs = flat_bytes(b.column(1))
        media = [encode(padded(buf[a:z])) for a, z in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        yield batch(_MEDIA, b.column(0), np.diff(offs), media)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: each text's padded payload as a JPEG."""
    ship(docs.sparkSession)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_encode, "row_id long, n_bytes long, media binary").withColumnRenamed("row_id", "doc_id")


_TENSORS = pa.schema([("row_id", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary())])


def tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width, rgb (row-major bytes) from a media column."""
    ship(media.sparkSession)

    def run(batches):
        for b in text_slices(batches, 1, 2 << 20):
            images = [Image(x.as_py()).rgb() for x in b.column(1)]
            yield batch(_TENSORS, b.column(0), [x.shape[0] for x in images], [x.shape[1] for x in images], [x.tobytes() for x in images])

    return plain(media, "doc_id", "media").mapInArrow(run, "row_id long, height int, width int, rgb binary").withColumnRenamed("row_id", "doc_id")


_DIGEST = pa.schema([("row_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def _digest(batches):
    for b in text_slices(batches, 2, 4 << 20):
        out: tuple[list, ...] = tuple([] for _ in range(6))
        for x in b.column(2):
            raw = x.as_py()
            image = Image(raw)
            payload, rgb = image.payload(), image.rgb()
            mean = rgb.reshape(-1, 3).mean(axis=0, dtype=np.float64)
            feature = f"{image.height}x{image.width}:" + ",".join(f"{v:.3f}" for v in mean)
            for to, v in zip(out, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature), strict=True):
                to.append(v)
        yield batch(_DIGEST, b.column(0), b.column(1), *out)


def digests(media: DataFrame) -> DataFrame:
    """What each stored image holds, read back from its bytes."""
    ship(media.sparkSession)
    ddl = "row_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return plain(media, "doc_id", "n_bytes", "media").mapInArrow(_digest, ddl).withColumnRenamed("row_id", "doc_id")
