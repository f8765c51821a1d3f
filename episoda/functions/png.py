"""PNG in plain Python and NumPy: 8-bit grey, RGB, RGBA, grey with alpha and palette images, strict about lengths and checksums."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_MAGIC = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


class PngError(ValueError):
    """The payload is not a whole, valid PNG of a supported kind."""


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(pixels: np.ndarray, level: int = 6) -> bytes:
    """pixels: (height, width) grey or (height, width, 3) RGB, uint8. Rows are stored unfiltered."""
    if pixels.dtype != np.uint8 or pixels.ndim not in (2, 3) or (pixels.ndim == 3 and pixels.shape[2] != 3) or not pixels.size:
        raise PngError("only non-empty 8-bit grey or RGB images are written")
    height, width = pixels.shape[:2]
    rows = np.zeros((height, 1 + pixels[0].size), np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, 0 if pixels.ndim == 2 else 2, 0, 0, 0)
    return _MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def _chunks(data: bytes):
    at = len(_MAGIC)
    while at < len(data):
        if at + 12 > len(data):
            raise PngError("truncated chunk")
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) < n or at + 12 + n > len(data):
            raise PngError("truncated chunk")
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise PngError("chunk checksum differs")
        yield kind, body
        at += 12 + n
        if kind == b"IEND":
            return
    raise PngError("no end chunk")


def _unfilter(raw: np.ndarray, step: int) -> np.ndarray:
    """Undo row filters of equally sized images: raw (images, height, 1 + width * step) to (images, height, width, step).

    A pixel needs its left, upper and upper-left neighbours, so pixels on one anti-diagonal do not depend on each other: the images are
    sheared until diagonals are contiguous, and each diagonal of all rows of all images is one vector operation.
    """
    kinds, n, height = raw[:, :, 0], raw.shape[0], raw.shape[1]
    width = (raw.shape[2] - 1) // step
    rows = raw[:, :, 1:].reshape(n, height, width, step)
    if not kinds.any():
        return rows
    if kinds.max() > 4:
        raise PngError("unknown row filter")
    if kinds.max() <= 2 and (kinds == kinds[:, :1]).all():
        out = rows.copy()
        for k, axis in ((1, 2), (2, 1)):
            own = kinds[:, 0] == k
            out[own] = np.cumsum(rows[own], axis, dtype=np.uint8)
        return out
    steps = width + height - 1
    sheared = np.zeros((steps, n, height, step), np.int16)
    for y in range(height):
        sheared[y : y + width, :, y] = rows[:, y].transpose(1, 0, 2)
    mask = {k: (kinds == k)[:, :, None] for k in (1, 2, 3, 4)}
    use = {k: bool(m.any()) for k, m in mask.items()}
    left_of, above_left = np.zeros((2, n, height, step), np.int16)
    above = np.zeros((n, height, step), np.int16)
    for d in range(steps):
        lo, hi = max(0, d - width + 1), min(height, d + 1)
        a, b, c = left_of[:, lo:hi], above[:, lo:hi], above_left[:, lo:hi]
        now = sheared[d, :, lo:hi]
        guess = np.zeros_like(now)
        if use[1]:
            guess += np.where(mask[1][:, lo:hi], a, 0)
        if use[2]:
            guess += np.where(mask[2][:, lo:hi], b, 0)
        if use[3]:
            guess += np.where(mask[3][:, lo:hi], (a + b) >> 1, 0)
        if use[4]:
            pa, pb = b - c, a - c
            pc = np.abs(pa + pb)
            np.abs(pa, out=pa)
            np.abs(pb, out=pb)
            best = np.where((pa <= pb) & (pa <= pc), a, np.where(pb <= pc, b, c))
            guess += np.where(mask[4][:, lo:hi], best, 0)
        now += guess
        now &= 255
        # the next diagonal's neighbours: left is this one, above is this one a row up, and upper left is what was above
        above_left, above = above, above_left
        above[:, 1:] = 0
        above[:, lo + 1 : hi + 1] = now[:, : min(hi, height - 1) - lo]
        left_of[:, lo:hi] = now
        if d - width + 1 >= 0:
            left_of[:, lo] = 0
    out = np.empty((n, height, width, step), np.uint8)
    for y in range(height):
        out[:, y] = sheared[y : y + width, :, y].transpose(1, 0, 2)
    return out


def _parse(data: bytes) -> tuple[tuple, np.ndarray | None, np.ndarray]:
    """((height, width, samples a pixel, colour), palette, filtered rows)."""
    if data[:8] != _MAGIC:
        raise PngError("not a PNG")
    head, palette, parts = None, None, []
    for kind, body in _chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
    if head is None:
        raise PngError("no header")
    width, height, depth, colour, _, _, interlaced = head
    if depth != 8 or colour not in _CHANNELS or interlaced or not width or not height:
        raise PngError("only plain 8-bit images are read")
    step = _CHANNELS[colour]
    try:
        raw = zlib.decompress(b"".join(parts))
    except zlib.error as e:
        raise PngError(f"pixel data: {e}") from None
    if len(raw) != height * (1 + width * step):
        raise PngError("pixel data has the wrong length")
    rows = np.frombuffer(raw, np.uint8).reshape(height, 1 + width * step)
    if rows[:, 0].max() > 4:
        raise PngError("unknown row filter")
    return (height, width, step, colour), palette, rows


def decode_many(payloads: list[bytes]) -> list[np.ndarray | PngError]:
    """Each payload's (height, width, channels) as stored, palettes resolved to RGB, or the error that it has. Images of one size are decoded together."""
    out: list[np.ndarray | PngError | None] = [None] * len(payloads)
    groups: dict[tuple, list[tuple[int, np.ndarray | None, np.ndarray]]] = {}
    for i, data in enumerate(payloads):
        try:
            key, palette, rows = _parse(data)
            groups.setdefault(key, []).append((i, palette, rows))
        except PngError as e:
            out[i] = e
        except (struct.error, ValueError) as e:
            out[i] = PngError(str(e))
    for (_, _, step, colour), own in groups.items():
        pixels = _unfilter(np.stack([rows for *_, rows in own]), step)
        for (i, palette, _), image in zip(own, pixels, strict=True):
            if colour != 3:
                out[i] = image
            elif palette is None or image.max() >= len(palette):
                out[i] = PngError("palette index out of range")
            else:
                out[i] = palette[image[:, :, 0]]
    return out


def decode(data: bytes) -> np.ndarray:
    """One image; raises PngError on anything short, damaged or unsupported."""
    (found,) = decode_many([data])
    if isinstance(found, PngError):
        raise found
    return found


def to_rgb(pixels: np.ndarray) -> np.ndarray:
    """Three channels; alpha is dropped."""
    if pixels.shape[2] in (1, 2):
        return np.repeat(pixels[:, :, :1], 3, 2)
    return pixels[:, :, :3]
