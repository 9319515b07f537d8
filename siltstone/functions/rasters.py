"""Pixel work in numpy for use inside Arrow functions: headers, PNG, resampling, hashes, masks, tiles.

Formats other than PNG need a decoder that the caller injects: ``decode(bytes) -> array (h, w, channels) uint8``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

Decoder = Callable[[bytes], np.ndarray]


def probe(blob: bytes | None) -> tuple[str, int, int] | None:
    """(format, width, height) from the header of a PNG, JPEG or WEBP file; None for anything else."""
    if not blob or len(blob) < 12:
        return None
    if blob[:8] == b"\x89PNG\r\n\x1a\n" and blob[12:16] == b"IHDR" and len(blob) >= 24:
        return ("PNG", *struct.unpack(">II", blob[16:24]))
    if blob[:4] == b"RIFF" and blob[8:12] == b"WEBP":
        return _webp(blob)
    return _jpeg(blob) if blob[:2] == b"\xff\xd8" else None


def orientation(blob: bytes) -> int:
    """How a camera held the picture, 1 to 8, from the TIFF block of a JPEG; 1 where it does not say."""
    at = 2
    while blob[:2] == b"\xff\xd8" and at + 4 <= len(blob) and blob[at] == 0xFF and blob[at + 1] != 0xDA:
        n = int.from_bytes(blob[at + 2 : at + 4], "big")
        if blob[at + 1] == 0xE1 and blob[at + 4 : at + 10] == b"Exif\0\0":
            tiff = blob[at + 10 : at + 2 + n]
            order = "little" if tiff[:2] == b"II" else "big"
            first = int.from_bytes(tiff[4:8], order)
            for i in range(int.from_bytes(tiff[first : first + 2], order)):
                entry = tiff[first + 2 + 12 * i : first + 14 + 12 * i]
                if int.from_bytes(entry[:2], order) == 0x0112:
                    value = int.from_bytes(entry[8:10], order)
                    return value if 1 <= value <= 8 else 1
            return 1
        at += 2 + n
    return 1


def upright(pixels: np.ndarray, held: int) -> np.ndarray:
    """Stored pixels as they are meant to be seen."""
    if held in (5, 6, 7, 8):
        pixels = pixels.swapaxes(0, 1)
    if held in (2, 3, 6, 7):
        pixels = pixels[:, ::-1]
    return pixels[::-1] if held in (3, 4, 7, 8) else pixels


def intact(blob: bytes | None) -> bool:
    """Whether the body of an image file is all there: chunks of a PNG with right sums and pixel data that inflates, the
    end mark of a JPEG, the stated length of a WEBP."""
    if not blob or len(blob) < 12:
        return False
    if blob[:2] == b"\xff\xd8":
        return blob.rstrip(b"\0")[-2:] == b"\xff\xd9"
    if blob[:4] == b"RIFF":
        return int.from_bytes(blob[4:8], "little") + 8 <= len(blob)
    at, pixels = 8, zlib.decompressobj()
    try:
        while at + 12 <= len(blob):
            n, name = int.from_bytes(blob[at : at + 4], "big"), blob[at + 4 : at + 8]
            body = blob[at + 8 : at + 8 + n]
            if zlib.crc32(name + body) != int.from_bytes(blob[at + 8 + n : at + 12 + n], "big"):
                return False
            if name == b"IDAT":
                pixels.decompress(body)
            if name == b"IEND":
                return pixels.eof
            at += 12 + n
    except zlib.error:
        return False
    return False


def _webp(blob: bytes) -> tuple[str, int, int] | None:
    kind, data = blob[12:16], blob[20:]
    if kind == b"VP8X" and len(data) >= 10:
        return "WEBP", 1 + int.from_bytes(data[4:7], "little"), 1 + int.from_bytes(data[7:10], "little")
    if kind == b"VP8L" and len(data) >= 5 and data[0] == 0x2F:
        bits = int.from_bytes(data[1:5], "little")
        return "WEBP", 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if kind == b"VP8 " and data[3:6] == b"\x9d\x01\x2a" and len(data) >= 10:
        return "WEBP", int.from_bytes(data[6:8], "little") & 0x3FFF, int.from_bytes(data[8:10], "little") & 0x3FFF
    return None


def _jpeg(blob: bytes) -> tuple[str, int, int] | None:
    at = 2
    while at + 9 <= len(blob) and blob[at] == 0xFF:
        marker = blob[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in (0x01, *range(0xD0, 0xD9)):
            at += 2
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", blob[at + 5 : at + 9])
            return "JPEG", w, h
        else:
            at += 2 + int.from_bytes(blob[at + 2 : at + 4], "big")
    return None


def decode_png(blob: bytes) -> np.ndarray:
    """An 8-bit, not interlaced PNG as (h, w, channels)."""
    if probe(blob) is None or blob[:4] != b"\x89PNG":
        raise ValueError("not a PNG")
    at, data, palette = 8, [], None
    w, h, depth, kind, _, _, interlaced = struct.unpack(">IIBBBBB", blob[16:29])
    while at < len(blob):
        (n,), name = struct.unpack(">I", blob[at : at + 4]), blob[at + 4 : at + 8]
        body = blob[at + 8 : at + 8 + n]
        if zlib.crc32(name + body) != int.from_bytes(blob[at + 8 + n : at + 12 + n], "big"):
            raise ValueError("broken PNG chunk")
        if name == b"IDAT":
            data.append(body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        at += 12 + n
    if depth != 8 or interlaced:
        raise ValueError("only 8-bit PNGs without interlacing")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    above = np.zeros(w * channels, np.int32)
    for y in range(h):
        out[y] = above = _unfilter(int(lines[y, 0]), lines[y, 1:].astype(np.int32), above.astype(np.int32), channels)
    out = out.reshape(h, w, channels)
    return palette[out[:, :, 0]] if palette is not None and kind == 3 else out


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return (line + above) & 255
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0).reshape(-1) & 255
    for x in range(len(line)):
        left, corner = (line[x - step], above[x - step]) if x >= step else (0, 0)
        if kind == 3:
            guess = (left + above[x]) // 2
        else:
            p = left + above[x] - corner
            da, db, dc = abs(p - left), abs(p - above[x]), abs(p - corner)
            guess = left if da <= db and da <= dc else above[x] if db <= dc else corner
        line[x] = (line[x] + guess) & 255
    return line


def encode_png(pixels: np.ndarray) -> bytes:
    """(h, w) or (h, w, channels) uint8 as a PNG."""
    p = pixels if pixels.ndim == 3 else pixels[:, :, None]
    h, w, c = p.shape
    raw = np.zeros((h, 1 + w * c), np.uint8)
    raw[:, 1:] = p.reshape(h, -1)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + chunk(b"IEND", b"")


def decode(blob: bytes, other: Decoder | None = None) -> np.ndarray:
    """RGB pixels; alpha is laid over white.  A decoder gives pixels as stored; how a camera held them is applied here."""
    pixels = decode_png(blob) if blob[:4] == b"\x89PNG" or other is None else upright(other(blob), orientation(blob))
    if pixels.ndim == 2 or pixels.shape[2] == 1:
        pixels = np.repeat(pixels.reshape(*pixels.shape[:2], 1), 3, axis=2)
    elif pixels.shape[2] == 2:
        pixels = np.concatenate([np.repeat(pixels[:, :, :1], 3, axis=2), pixels[:, :, 1:]], axis=2)
    if pixels.shape[2] == 4:
        alpha = pixels[:, :, 3:].astype(np.float64) / 255
        pixels = np.rint(pixels[:, :, :3] * alpha + 255 * (1 - alpha)).astype(np.uint8)
    return pixels


def _weights(n: int, m: int, kernel: Callable[[np.ndarray], np.ndarray], reach: float) -> np.ndarray:
    """(m, n) weights of a resampling from n to m samples; the kernel widens when shrinking."""
    scale = n / m
    wide = max(scale, 1.0)
    centre = (np.arange(m) + 0.5) * scale - 0.5
    x = (np.arange(n)[None, :] - centre[:, None]) / wide
    out = np.where(np.abs(x) < reach, kernel(x), 0.0)
    return out / out.sum(axis=1, keepdims=True)


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    x = np.abs(x)
    return np.where(x < 1, (a + 2) * x**3 - (a + 3) * x**2 + 1, a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a)


def _area(n: int, m: int) -> np.ndarray:
    """(m, n) shares by which input samples are covered by output samples."""
    edges = np.arange(m + 1) * n / m
    low = np.maximum(edges[:-1, None], np.arange(n)[None, :])
    high = np.minimum(edges[1:, None], np.arange(1, n + 1)[None, :])
    out = np.maximum(0.0, high - low)
    return out / out.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, w: int, h: int, kernel: str) -> np.ndarray:
    """Resample to (h, w) with the AREA or BICUBIC kernel."""
    if kernel == "KEEP":
        return pixels
    make = _area if kernel == "AREA" else lambda n, m: _weights(n, m, _cubic, 2.0)
    p = pixels.astype(np.float64)
    p = np.tensordot(make(p.shape[0], h), p, (1, 0))
    p = np.moveaxis(np.tensordot(make(p.shape[1], w), p, (1, 1)), 0, 1)
    return np.clip(np.rint(p), 0, 255).astype(np.uint8)


def _dct(n: int) -> np.ndarray:
    k, i = np.arange(n)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * i + 1) / (2 * n))


def perceptual_hash(pixels: np.ndarray, side: int = 8, factor: int = 4) -> int:
    """64 bits: which low frequencies of the grey picture lie above their median; the first bit is the highest."""
    n = side * factor
    grey = np.rint(pixels[:, :, :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    small = resize(grey[:, :, None], n, n, "BICUBIC")[:, :, 0].astype(np.float64)
    low = (_dct(n) @ small @ _dct(n).T)[:side, :side]
    bits = (low > np.median(low)).ravel()
    value = int("".join("1" if b else "0" for b in bits), 2)
    return value - (1 << 64) if value >= 1 << 63 else value


def hex_of(value: int) -> str:
    return f"{value & (1 << 64) - 1:016x}"


def fill_polygons(h: int, w: int, polygons: list[np.ndarray]) -> np.ndarray:
    """A mask (h, w) with 255 inside and on the edge of each polygon, by the even-odd rule."""
    mask = np.zeros((h, w), np.uint8)
    for corners in polygons:
        pts = np.asarray(corners, np.float64)
        x0, y0 = np.maximum(np.floor(pts.min(axis=0)).astype(int), 0)
        x1, y1 = np.minimum(np.ceil(pts.max(axis=0)).astype(int), (w - 1, h - 1))
        if x1 < x0 or y1 < y0:
            continue
        ys, xs = np.mgrid[y0 : y1 + 1, x0 : x1 + 1]
        inside = np.zeros(xs.shape, bool)
        edge = np.zeros(xs.shape, bool)
        for (ax, ay), (bx, by) in zip(pts, np.roll(pts, -1, axis=0)):
            crosses = (ay > ys) != (by > ys)
            with np.errstate(divide="ignore", invalid="ignore"):
                inside ^= crosses & (xs < (bx - ax) * (ys - ay) / (by - ay) + ax)
            length = max(np.hypot(bx - ax, by - ay), 1e-9)
            along = np.clip(((xs - ax) * (bx - ax) + (ys - ay) * (by - ay)) / length**2, 0, 1)
            edge |= np.hypot(xs - ax - along * (bx - ax), ys - ay - along * (by - ay)) <= 0.5
        mask[y0 : y1 + 1, x0 : x1 + 1][inside | edge] = 255
    return mask


def dilate(mask: np.ndarray, size: int) -> np.ndarray:
    """The largest value in a square of ``size`` around each pixel."""
    if size <= 1:
        return mask
    before, after = size // 2, size - 1 - size // 2
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (before, after)
        p = np.pad(mask, pad)
        mask = np.max([np.take(p, range(i, i + mask.shape[axis]), axis) for i in range(size)], axis=0)
    return mask


def fit_mask(mask: np.ndarray, h: int, w: int) -> np.ndarray:
    """A mask scaled to a picture's size by nearest neighbour, as 0 or 255."""
    ys, xs = np.arange(h) * mask.shape[0] // h, np.arange(w) * mask.shape[1] // w
    return np.where(mask[ys][:, xs] > 127, 255, 0).astype(np.uint8)


def pad_to(pixels: np.ndarray, multiple: int = 8) -> np.ndarray:
    """Mirror the edges so that both sides are multiples."""
    h, w = pixels.shape[:2]
    pad = [(0, -h % multiple), (0, -w % multiple)] + [(0, 0)] * (pixels.ndim - 2)
    return np.pad(pixels, pad, mode="symmetric")


def tiles(n: int, tile: int = 1024, overlap: int = 64) -> list[tuple[int, int]]:
    """Overlapping ranges that cover ``n`` pixels."""
    if n <= tile:
        return [(0, n)]
    starts = list(range(0, n - tile, tile - overlap)) + [n - tile]
    return [(a, a + tile) for a in starts]


def blend_tiles(pixels: np.ndarray, mask: np.ndarray, paint: Callable[[np.ndarray, np.ndarray], np.ndarray], tile: int = 1024, overlap: int = 64, above: int = 8_000_000) -> np.ndarray:
    """Paint a picture, in overlapping tiles if it is large; tiles are averaged with weights that fall towards inner
    edges, so overlaps are true weighted means and borders keep full weight."""
    h, w = pixels.shape[:2]
    if h * w <= above:
        return paint(pad_to(pixels), pad_to(mask))[:h, :w]
    total, weight = np.zeros(pixels.shape, np.float64), np.zeros((h, w, 1))

    def ramp(a: int, b: int, n: int) -> np.ndarray:
        r = np.ones(b - a)
        k = min(overlap, b - a)
        slope = (np.arange(k) + 1) / (k + 1)
        if a > 0:
            r[:k] = np.minimum(r[:k], slope)
        if b < n:
            r[-k:] = np.minimum(r[-k:], slope[::-1])
        return r

    for y0, y1 in tiles(h, tile, overlap):
        for x0, x1 in tiles(w, tile, overlap):
            part = paint(pad_to(pixels[y0:y1, x0:x1]), pad_to(mask[y0:y1, x0:x1]))[: y1 - y0, : x1 - x0]
            k = (ramp(y0, y1, h)[:, None] * ramp(x0, x1, w)[None, :])[:, :, None]
            total[y0:y1, x0:x1] += part * k
            weight[y0:y1, x0:x1] += k
    return np.clip(np.rint(total / weight), 0, 255).astype(np.uint8)


def convex_hull_area(points: np.ndarray) -> float:
    """Area of the convex hull of points (n, 2)."""
    pts = sorted(map(tuple, np.asarray(points, float)))

    def half(ordered: list) -> list:
        out: list = []
        for p in ordered:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    hull = half(pts) + half(pts[::-1])
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(hull, hull[1:] + hull[:1]))) / 2


def rotation(h: int, w: int, degrees: float) -> np.ndarray:
    """The 2 x 3 map of a counter-clockwise turn about the centre of a picture."""
    c, s = np.cos(np.deg2rad(degrees)), np.sin(np.deg2rad(degrees))
    turn = np.array([[c, s], [-s, c]])
    centre = np.array([w / 2, h / 2])
    return np.column_stack([turn, centre - turn @ centre])


def rotate(pixels: np.ndarray, degrees: float) -> np.ndarray:
    """The picture turned about its centre in its own frame: bilinear, edges repeated outwards."""
    h, w = pixels.shape[:2]
    back = np.linalg.inv(np.vstack([rotation(h, w, degrees), [0, 0, 1]]))
    ys, xs = np.mgrid[0:h, 0:w]
    x = np.clip(back[0, 0] * xs + back[0, 1] * ys + back[0, 2], 0, w - 1)
    y = np.clip(back[1, 0] * xs + back[1, 1] * ys + back[1, 2], 0, h - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    x1, y1 = np.minimum(x0 + 1, w - 1), np.minimum(y0 + 1, h - 1)
    fx, fy = (x - x0)[..., None], (y - y0)[..., None]
    p = pixels.reshape(h, w, -1).astype(np.float64)
    mixed = (p[y0, x0] * (1 - fx) + p[y0, x1] * fx) * (1 - fy) + (p[y1, x0] * (1 - fx) + p[y1, x1] * fx) * fy
    return np.rint(mixed).astype(np.uint8).reshape(pixels.shape)
