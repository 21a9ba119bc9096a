"""PNG tiles with numpy and zlib: 8 bits a sample, grey, palette or colour, with or without alpha, not interlaced."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# The format's signature and the samples of its colour types.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 1:  # each sample is a difference to the pixel before
        return np.cumsum(line.reshape(-1, step), axis=0, dtype="u1").reshape(-1)
    if kind == 2:
        return line + above
    out = np.zeros(len(line) + step, "i4")  # one pixel of zeros before
    corner = np.concatenate([np.zeros(step, "i4"), above.astype("i4")])
    for i, x in enumerate(line.tolist()):
        left, up, before = int(out[i]), int(corner[i + step]), int(corner[i])
        if kind == 3:
            near = (left + up) // 2
        else:
            off = left + up - before
            near = min((abs(off - left), 0, left), (abs(off - up), 1, up), (abs(off - before), 2, before))[2]
        out[i + step] = (x + near) & 255
    return out[step:].astype("u1")


def decode(data: bytes) -> np.ndarray:
    """(h, w, 3) or, with alpha, (h, w, 4) of bytes."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at, packed, palette, clear = 8, b"", None, b""
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height, bits, colour, _, _, interlaced = struct.unpack(">2I5B", body)
            if bits != 8 or interlaced:
                raise ValueError("only 8 bits a sample and no interlacing")
        elif kind == b"PLTE":
            palette = np.frombuffer(body, "u1").reshape(-1, 3)
        elif kind == b"tRNS":
            clear = body
        elif kind == b"IDAT":
            packed += body
        at += 12 + size
    step = SAMPLES[colour]
    rows = np.frombuffer(zlib.decompress(packed), "u1").reshape(height, 1 + width * step)
    out, above = np.zeros((height, width * step), "u1"), np.zeros(width * step, "u1")
    for y in range(height):
        above = out[y] = rows[y, 1:] if rows[y, 0] == 0 else _unfilter(int(rows[y, 0]), rows[y, 1:], above, step)
    image = out.reshape(height, width, step)
    if colour == 3:
        alpha = np.full((len(palette), 1), 255, "u1")
        alpha[: len(clear), 0] = np.frombuffer(clear, "u1")
        image = (np.hstack([palette, alpha]) if clear else palette)[image[..., 0]]
    elif colour in (0, 4):
        image = np.concatenate([np.repeat(image[..., :1], 3, axis=2), image[..., 1:]], axis=2)
    return image


def encode(image: np.ndarray) -> bytes:
    """(h, w, 3 or 4) of bytes, unfiltered."""
    h, w, n = image.shape
    rows = np.concatenate([np.zeros((h, 1), "u1"), image.reshape(h, w * n)], axis=1).tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">2I5B", w, h, 8, {3: 2, 4: 6}[n], 0, 0, 0)
    return SIGNATURE + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")
