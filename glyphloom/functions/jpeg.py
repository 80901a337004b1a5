"""Baseline JPEG in NumPy: 8 by 8 cosine coefficients, chroma at half resolution in either direction, and entropy coding with tables made for each image."""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: Fixed: quantisation tables of ITU-T T.81, annex K, for luminance and chrominance.
Q_LUMA = np.array([
    [16, 11, 10, 16, 24, 40, 51, 61], [12, 12, 14, 19, 26, 58, 60, 55], [14, 13, 16, 24, 40, 57, 69, 56], [14, 17, 22, 29, 51, 87, 80, 62],
    [18, 22, 37, 56, 68, 109, 103, 77], [24, 35, 55, 64, 81, 104, 113, 92], [49, 64, 78, 87, 103, 121, 120, 101], [72, 92, 95, 98, 112, 100, 103, 99],
])
Q_CHROMA = np.full((8, 8), 99)
Q_CHROMA[:4, :4] = [[17, 18, 24, 47], [18, 21, 26, 66], [24, 26, 56, 99], [47, 66, 99, 99]]

_N = np.arange(8)
DCT = np.where(_N[:, None] == 0, np.sqrt(1 / 8), np.sqrt(2 / 8) * np.cos((2 * _N[None, :] + 1) * _N[:, None] * np.pi / 16))
YCC = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])
#: Places of a block along its diagonals, up and down by turns.
ZIGZAG = np.array([8 * i + j for i, j in sorted(((i, j) for i in range(8) for j in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))])
LONGEST = 16


def tables(quality: int) -> list[np.ndarray]:
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    return [np.clip((q * scale + 50) // 100, 1, 255).astype(np.int64) for q in (Q_LUMA, Q_CHROMA)]


def coefficients(a: np.ndarray, quality: int) -> list[np.ndarray]:
    """Quantised coefficients of the three planes, as (rows of blocks, blocks, 8, 8)."""
    h, w = a.shape[:2]
    p = np.pad(a, ((0, -h % 16), (0, -w % 16), (0, 0)), mode="edge").astype(float) @ YCC.T
    out = []
    for i, q in zip(range(3), (0, 1, 1)):
        plane = p[..., i]
        if i:
            plane = plane.reshape(plane.shape[0] // 2, 2, plane.shape[1] // 2, 2).mean((1, 3))
        else:
            plane = plane - 128
        b = plane.reshape(plane.shape[0] // 8, 8, plane.shape[1] // 8, 8).transpose(0, 2, 1, 3)
        out.append(np.rint(DCT @ b @ DCT.T / tables(quality)[q]).astype(np.int64))
    return out


def pixels(planes: list[np.ndarray], quality: int, h: int, w: int) -> np.ndarray:
    """The image that coefficients stand for."""
    out = []
    for i, (b, q) in enumerate(zip(planes, (0, 1, 1))):
        x = DCT.T @ (b * tables(quality)[q]) @ DCT
        plane = x.transpose(0, 2, 1, 3).reshape(b.shape[0] * 8, b.shape[1] * 8)
        out.append(plane.repeat(2, 0).repeat(2, 1)[:h, :w] if i else plane[:h, :w] + 128)
    return np.clip(np.rint(np.stack(out, 2) @ np.linalg.inv(YCC).T), 0, 255).astype(np.uint8)


def lengths(counts: np.ndarray) -> np.ndarray:
    """Bits of the code of each symbol (0: none), at most LONGEST; the code of all ones stays free."""
    counts = counts.copy()
    while True:
        heap = [(int(n), i, (i,)) for i, n in enumerate(counts) if n] + [(0, len(counts), (len(counts),))]
        heapq.heapify(heap)
        out = np.zeros(len(counts) + 1, np.int64)
        while len(heap) > 1:
            m, _, x = heapq.heappop(heap)
            n, i, y = heapq.heappop(heap)
            out[list(x + y)] += 1
            heapq.heappush(heap, (m + n, i, x + y))
        if out.max() <= LONGEST:
            return out[:-1]
        counts = np.where(counts > 0, (counts + 1) // 2, 0)  # flatter, so that the longest codes get shorter


def codes(bits: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The code of each symbol, and the symbols in order of their codes."""
    order = [int(s) for s in np.lexsort((np.arange(len(bits)), bits)) if bits[s]]
    out, code, last = np.zeros(len(bits), np.int64), 0, 0
    for s in order:
        code <<= int(bits[s]) - last
        last = int(bits[s])
        out[s] = code
        code += 1
    return out, order


def _size(x: np.ndarray) -> np.ndarray:
    """Bits of the magnitude."""
    return np.ceil(np.log2(np.abs(x) + 1)).astype(np.int64)


def _scan(planes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Blocks in the order in which they are coded, and whether each is chroma: four of luminance, then one of either chroma."""
    y, cb, cr = planes
    rows, cols = cb.shape[:2]
    four = y.reshape(rows, 2, cols, 2, 64).transpose(0, 2, 1, 3, 4).reshape(rows * cols, 4, 64)
    units = np.concatenate([four, cb.reshape(-1, 1, 64), cr.reshape(-1, 1, 64)], axis=1)[..., ZIGZAG]
    units[:, :4, 0] = np.diff(units[:, :4, 0].ravel(), prepend=0).reshape(-1, 4)
    for c in (4, 5):
        units[:, c, 0] = np.diff(units[:, c, 0], prepend=0)
    return units.reshape(-1, 64), np.tile([False] * 4 + [True] * 2, rows * cols)


def encode(a: np.ndarray, quality: int) -> bytes:
    """A JPEG file of an RGB image."""
    blocks, chroma = _scan(coefficients(a, quality))
    n = len(blocks)
    size = _size(blocks)
    at, col = np.nonzero(blocks[:, 1:])
    col += 1
    before = np.concatenate([[0], np.where(at[1:] == at[:-1], col[:-1], 0)]) if len(at) else np.zeros(0, np.int64)
    run = col - before - 1
    far = np.repeat(np.arange(len(at)), run // 16)
    last = np.zeros(n, np.int64)
    last[at] = col  # the last one of a row wins
    ends = np.flatnonzero(last < 63)
    place = np.concatenate([np.arange(n) * 256, at * 256 + 2 * col + 1, at[far] * 256 + 2 * col[far], ends * 256 + 255])
    symbol = np.concatenate([size[:, 0], run % 16 * 16 + size[at, col], np.full(len(far), 0xF0), np.zeros(len(ends), np.int64)])
    value = np.concatenate([blocks[:, 0], blocks[at, col], np.zeros(len(far) + len(ends), np.int64)])
    extra = np.concatenate([size[:, 0], size[at, col], np.zeros(len(far) + len(ends), np.int64)])
    table = np.concatenate([np.zeros(n, np.int64), np.full(len(at) + len(far) + len(ends), 2)]) + chroma[place // 256]
    order = np.argsort(place, kind="stable")
    symbol, value, extra, table = symbol[order], value[order], extra[order], table[order]
    value = np.where(value < 0, value + (1 << extra) - 1, value)
    coded, width, heads = np.zeros(len(symbol), np.int64), np.zeros(len(symbol), np.int64), []
    for t in range(4):  # DC and AC, each of luminance and chroma
        own = table == t
        bits = lengths(np.bincount(symbol[own], minlength=256))
        code, inside = codes(bits)
        coded[own], width[own] = code[symbol[own]], bits[symbol[own]]
        heads.append(bytes([t // 2 << 4 | t % 2]) + np.bincount(bits[inside], minlength=17)[1:].astype(np.uint8).tobytes() + bytes(inside))
    word, width = coded << extra | value, width + extra
    stop = np.cumsum(width)
    bit = np.repeat(stop, width) - np.arange(int(stop[-1])) - 1
    stream = np.packbits(np.concatenate([(np.repeat(word, width) >> bit & 1).astype(np.uint8), np.ones(-int(stop[-1]) % 8, np.uint8)])).tobytes()

    def segment(mark: int, body: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, mark, len(body) + 2) + body

    h, w = a.shape[:2]
    out = [b"\xff\xd8", segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0")]
    out += [segment(0xDB, bytes([i]) + q.ravel()[ZIGZAG].astype(np.uint8).tobytes()) for i, q in enumerate(tables(quality))]
    out.append(segment(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x22, 0, 2, 0x11, 1, 3, 0x11, 1])))
    out += [segment(0xC4, head) for head in heads]
    return b"".join([*out, segment(0xDA, bytes([3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0])), stream.replace(b"\xff", b"\xff\0"), b"\xff\xd9"])
