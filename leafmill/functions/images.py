"""Pixels, which need Python: perceptual hash, crops, PNG. Arrays are rows x columns (x RGB) of bytes."""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np


@lru_cache(8)
def _cosines(n: int) -> np.ndarray:
    k = np.arange(n)
    return np.cos(np.pi / n * (k[None, :] + 0.5) * k[:, None])


def resize(gray: np.ndarray, size: int) -> np.ndarray:
    """Area means on a size x size grid; single pixels where the image is smaller."""
    h, w = gray.shape
    ys, xs = (np.linspace(0, n, size + 1) for n in (h, w))
    total = np.zeros((h + 1, w + 1))
    total[1:, 1:] = gray.cumsum(0).cumsum(1)
    y0, x0 = np.minimum(ys[:-1].astype(int), h - 1), np.minimum(xs[:-1].astype(int), w - 1)
    y1, x1 = np.maximum(y0 + 1, np.ceil(ys[1:]).astype(int)), np.maximum(x0 + 1, np.ceil(xs[1:]).astype(int))
    area = (y1 - y0)[:, None] * (x1 - x0)[None, :]
    return (total[np.ix_(y1, x1)] - total[np.ix_(y0, x1)] - total[np.ix_(y1, x0)] + total[np.ix_(y0, x0)]) / area


def perceptual_hash(image: np.ndarray, size: int = 12, factor: int = 4) -> str:
    """Low frequencies of the cosine transform against their median: size * size bits as hex."""
    gray = image if image.ndim == 2 else image[..., :3] @ np.array([0.299, 0.587, 0.114])
    small = resize(gray.astype(np.float64), size * factor)
    c = _cosines(size * factor)
    low = (c @ small @ c.T)[:size, :size]
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('01'[int(b)] for b in bits), 2):0{size * size // 4}x}"


def crop(image: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> np.ndarray:
    return image[y1:y2, x1:x2]


def rotate(image: np.ndarray, correction: str | None) -> np.ndarray:
    """Turned by the correction's name; anything else leaves it."""
    turns = {"rotate_90_cw": 3, "rotate_180": 2, "rotate_90_ccw": 1}.get(correction or "", 0)
    return np.ascontiguousarray(np.rot90(image, turns))


def shrunk(image: np.ndarray, most: int) -> np.ndarray:
    """So that neither side is above most, each pixel the mean of those it stands for; a smaller image stays."""
    scale = min(1.0, most / max(image.shape[:2]))
    sides = [max(1, round(n * scale)) for n in image.shape[:2]]
    for axis, fresh in enumerate(sides):
        n = image.shape[axis]
        edges = np.arange(fresh) * n // fresh
        size = np.diff(np.append(edges, n)).reshape([-1 if k == axis else 1 for k in range(image.ndim)])
        image = np.add.reduceat(image.astype(np.float64), edges, axis=axis) / size
    return np.clip(np.round(image), 0, 255).astype(np.uint8)


def encode_png(image: np.ndarray, level: int = 0) -> bytes:
    """An RGB or gray PNG; channels are written in the order they have."""
    h, w = image.shape[:2]
    rows = np.ascontiguousarray(image, np.uint8).reshape(h, -1)
    raw = np.hstack([np.zeros((h, 1), np.uint8), rows]).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """8-bit gray, RGB or RGBA, not interlaced."""
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += n + 12
    if head is None or head[2] != 8 or head[3] not in (0, 2, 6) or head[6]:
        raise ValueError("only plain 8-bit PNG is read")
    w, h, step = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, w * step + 1)
    out = np.zeros((h, w * step), np.uint8)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].copy()
        up = out[y - 1] if y else np.zeros(w * step, np.uint8)
        if kind == 2:
            line += up
        elif kind in (1, 3, 4):
            for i in range(w * step):
                a = int(line[i - step]) if i >= step else 0
                b, c = int(up[i]), int(up[i - step]) if i >= step else 0
                p = a + b - c
                near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                line[i] = (int(line[i]) + (a if kind == 1 else (a + b) // 2 if kind == 3 else near)) & 255
        out[y] = line
    return out.reshape(h, w) if step == 1 else out.reshape(h, w, step)
