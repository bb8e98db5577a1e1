"""Grey images from and to bytes: BMP, PNG and TIFF (strips or tiles; plain, deflate, LZW or PackBits), on NumPy and zlib alone.

An image with channels gives its first one (red); palettes are looked up.  What the decoders don't know raises ValueError,
which the frame's row then carries.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SUFFIXES = ("bmp", "png", "tif", "tiff")


def decode(data: bytes) -> np.ndarray:
    if data[:2] == b"BM":
        return decode_bmp(data)
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return decode_png(data)
    if data[:4] in (b"II*\x00", b"MM\x00*"):
        return decode_tiff(data)
    raise ValueError("not a BMP, PNG or TIFF image")


def decode_bmp(data: bytes) -> np.ndarray:
    start, header, width, height, _, bits, packing, _, _, _, colours = struct.unpack_from("<10xIIiiHHIIiiI", data)
    if packing not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError(f"BMP of {bits} bits and compression {packing} isn't supported")
    rows, stride = abs(height), (width * bits // 8 + 3) // 4 * 4
    if len(data) < start + rows * stride:
        raise ValueError("BMP is cut short")
    px = np.frombuffer(data, np.uint8, rows * stride, start).reshape(rows, stride)[:, : width * bits // 8]
    if bits == 8:
        palette = np.frombuffer(data, np.uint8, (colours or 256) * 4, 14 + header).reshape(-1, 4)[:, 2]
        px = np.pad(palette, (0, 256 - len(palette)))[px]
    else:
        px = px.reshape(rows, width, bits // 8)[:, :, 2]
    return np.ascontiguousarray(px[::-1] if height > 0 else px)


def encode_bmp(image: np.ndarray) -> bytes:
    rows, cols = image.shape
    stride = (cols + 3) // 4 * 4
    grey = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1)
    grey[:, 3] = 0
    body = np.zeros((rows, stride), np.uint8)
    body[:, :cols] = image[::-1]
    head = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 1078 + body.size, 0, 0, 1078, 40, cols, rows, 1, 8, 0, body.size, 2835, 2835, 256, 0)
    return head + grey.tobytes() + body.tobytes()


def decode_png(data: bytes) -> np.ndarray:
    at, packed, palette = 8, [], None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)[:, 0]
        elif kind == b"IDAT":
            packed.append(body)
        at += size + 12
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw, at = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8), 0
    out = np.zeros((height, width), np.uint8)
    for top, left, down, right in PASSES if interlaced else ((0, 0, 1, 1),):
        rows, cols = len(range(top, height, down)), len(range(left, width, right))
        if rows and cols:
            stride = (cols * channels * depth + 7) // 8
            lines = raw[at : at + rows * (stride + 1)].reshape(rows, stride + 1)
            at += lines.size
            out[top::down, left::right] = samples_of(unfiltered(lines, max(1, channels * depth // 8)), cols, depth, channels, colour == 3)
    return palette[out].astype(np.uint8) if colour == 3 else out


#: First row and column and steps of the passes of an interlaced PNG.
PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))


def samples_of(px: np.ndarray, cols: int, depth: int, channels: int, indexed: bool) -> np.ndarray:
    """The first channel of lines of bytes, in 8 bits or as indices of a palette."""
    if depth >= 8:
        return px.reshape(len(px), cols, channels * depth // 8)[:, :, 0]  # of 16 bits the high byte
    steps = np.arange(8 - depth, -1, -depth)
    px = ((px[:, :, None] >> steps) & ((1 << depth) - 1)).reshape(len(px), -1)[:, :cols]
    return px if indexed else px * (255 // ((1 << depth) - 1))


def unfiltered(raw: np.ndarray, unit: int) -> np.ndarray:
    out = np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for r, line in enumerate(raw):
        kind, line = line[0], line[1:]
        if kind == 0:
            now = line
        elif kind == 1:
            now = np.cumsum(line.reshape(-1, unit), axis=0, dtype=np.uint8).reshape(-1) if len(line) % unit == 0 else None
        elif kind == 2:
            now = line + above
        else:
            now, up = bytearray(line.tobytes()), above.tobytes()
            for i in range(len(now)):
                a, b, c = (now[i - unit], up[i], up[i - unit]) if i >= unit else (0, up[i], 0)
                if kind == 3:
                    guess = (a + b) >> 1
                else:
                    guess = min((a, b, c), key=lambda v, p=a + b - c: abs(p - v))
                now[i] = (now[i] + guess) & 255
            now = np.frombuffer(bytes(now), np.uint8)
        out[r] = above = now
    return out


def encode_png(image: np.ndarray, title: str = "") -> bytes:
    """An 8 bit PNG, grey or colour, with a title in its text chunk if there is one."""
    rows, cols = image.shape[:2]
    flat = image.reshape(rows, -1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = np.concatenate([np.zeros((rows, 1), np.uint8), flat], axis=1)
    head = struct.pack(">IIBBBBB", cols, rows, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    text = chunk(b"iTXt", b"Title\0\0\0\0\0" + title.encode()) if title else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + text + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_tiff(data: bytes) -> np.ndarray:
    order = "<" if data[:2] == b"II" else ">"
    at = struct.unpack_from(order + "I", data, 4)[0]
    tags = {}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        code, size = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}.get(kind, ("", 0))
        if code:
            place = at + 10 + 12 * k
            place = place if size * count <= 4 else struct.unpack_from(order + "I", data, place)[0]
            tags[tag] = struct.unpack_from(f"{order}{count}{code}", data, place)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    packing, bits, samples, predictor = one(259, 1), one(258, 1), one(277, 1), one(317, 1)
    unpack = {1: bytes, 5: unpacked_lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: unpacked_bits}.get(packing)
    if unpack is None or bits not in (8, 16) or predictor not in (1, 2) or one(284, 1) != 1:
        raise ValueError("TIFF: only 8 or 16 bits by pixel, plain, deflated, LZW or PackBits, are supported")
    rows, cols = tags[257][0], tags[256][0]
    tiled = 324 in tags
    high, wide = (tags[323][0], tags[322][0]) if tiled else (min(one(278, rows), rows), cols)
    out, across = np.zeros((rows, cols), np.uint8), -(-cols // wide)
    for k, (o, n) in enumerate(zip(tags[324 if tiled else 273], tags[325 if tiled else 279], strict=True)):
        top, left = k // across * high, k % across * wide
        there = high if tiled else min(high, rows - top)
        px = np.frombuffer(unpack(data[o : o + n]), np.dtype(f"{order}u{bits // 8}"), there * wide * samples).reshape(there, wide, samples)[:, :, 0]
        if predictor == 2:
            px = np.cumsum(px, axis=1, dtype=px.dtype)
        px = (px >> (bits - 8))[: rows - top, : cols - left]
        out[top : top + len(px), left : left + px.shape[1]] = px
    return 255 - out if one(262, 1) == 0 else out


def unpacked_bits(data: bytes) -> bytes:
    """PackBits: a count and as many bytes, or a count and one byte that many times."""
    out, at = bytearray(), 0
    while at < len(data):
        n, at = data[at], at + 1
        if n < 128:
            out += data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            out += data[at : at + 1] * (257 - n)
            at += 1
    return bytes(out)


CLEAR, END = 256, 257


def unpacked_lzw(data: bytes) -> bytes:
    """LZW of TIFF: codes of 9 to 12 bits, the highest first, which widen one entry before they must."""
    out, table, last = [], [], b""
    bits = held = 0
    width = 9
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == END:
            break
        if code == CLEAR:
            table, last, width = [bytes([k]) for k in range(256)] + [b"", b""], b"", 9
            continue
        if not table or code > len(table):
            raise ValueError("TIFF: LZW data is damaged")
        now = table[code] if code < len(table) else last + last[:1]
        out.append(now)
        if last:
            table.append(last + now[:1])
        last = now
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def block_mean(image: np.ndarray, factor: int) -> np.ndarray:
    """Smaller image of block means; blocks that stick out are filled with 0."""
    rows, cols = (-(-n // factor) * factor for n in image.shape)
    full = np.zeros((rows, cols))
    full[: image.shape[0], : image.shape[1]] = image
    means = full.reshape(rows // factor, factor, cols // factor, factor).mean(axis=(1, 3))
    return np.clip(np.round(means), 0, 255).astype(np.uint8)


def smoothed_smaller(image: np.ndarray, factor: int) -> np.ndarray:
    """Smaller image without aliases: a Gaussian of (factor - 1) / 2, read off by linear interpolation at the new pixels' centres."""
    if factor <= 1:
        return image
    sigma = (factor - 1) / 2
    reach = int(4 * sigma + 0.5)
    bell = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    share = (factor - 1) / 2 % 1
    taps = np.convolve(bell / bell.sum(), [1 - share, share])
    out = image.astype(np.float64)
    for axis in (0, 1):
        n = max(1, round(image.shape[axis] / factor))
        first = np.floor((np.arange(n) + 0.5) * factor - 0.5).astype(int) - reach
        size = out.shape[axis]
        at = (first[:, None] + np.arange(len(taps))) % (2 * size)
        at = np.minimum(at, 2 * size - 1 - at)  # edges mirrored
        out = sum(w * out.take(at[:, k], axis) for k, w in enumerate(taps))
    return np.clip(np.round(out), 0, 255).astype(np.uint8)
