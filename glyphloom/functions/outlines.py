"""TrueType outlines to pixels in NumPy, for workers that have no browser and no image library: cmap, simple and composite glyphs, advances, Arabic joining by presentation forms, right-to-left order of Arabic runs."""

from __future__ import annotations

import functools
import struct
import unicodedata

import numpy as np

from .unicode import class_ranges, members

OVER = 4


class Font:
    def __init__(self, data: bytes, index: int = 0):
        self.data = data
        at = struct.unpack_from(">I", data, 12 + 4 * index)[0] if data[:4] == b"ttcf" else 0
        self.tables = {}
        for i in range(struct.unpack_from(">H", data, at + 4)[0]):
            tag, _, offset, _ = struct.unpack_from(">4sIII", data, at + 12 + 16 * i)
            self.tables[tag] = offset
        if b"glyf" not in self.tables:
            raise ValueError("no TrueType outlines")
        self.em, self.long = struct.unpack_from(">H", data, self.tables[b"head"] + 18)[0], struct.unpack_from(">h", data, self.tables[b"head"] + 50)[0]
        self.up, self.down = struct.unpack_from(">hh", data, self.tables[b"hhea"] + 4)
        self.n_wide = struct.unpack_from(">H", data, self.tables[b"hhea"] + 34)[0]
        self.chars = self._cmap()
        self.glyph = functools.lru_cache(4096)(self._glyph)

    def _cmap(self) -> dict[int, int]:
        d, base = self.data, self.tables[b"cmap"]
        found: dict[int, int] = {}
        for i in range(struct.unpack_from(">H", d, base + 2)[0]):
            at = base + struct.unpack_from(">HHI", d, base + 4 + 8 * i)[2]
            kind = struct.unpack_from(">H", d, at)[0]
            if kind == 12:
                for k in range(struct.unpack_from(">I", d, at + 12)[0]):
                    a, b, g = struct.unpack_from(">III", d, at + 16 + 12 * k)
                    found.update(zip(range(a, b + 1), range(g, g + b - a + 1), strict=True))
            elif kind == 4:
                n = struct.unpack_from(">H", d, at + 6)[0] // 2
                ends = struct.unpack_from(f">{n}H", d, at + 14)
                starts, deltas, offsets = (struct.unpack_from(f">{n}H", d, at + 16 + 2 * n * k) for k in (1, 2, 3))
                for k in range(n):
                    for c in range(starts[k], ends[k] + 1 if ends[k] < 0xFFFF else ends[k]):
                        if offsets[k]:
                            g = struct.unpack_from(">H", d, at + 16 + 6 * n + 2 * k + offsets[k] + 2 * (c - starts[k]))[0]
                            g = g and (g + deltas[k]) & 0xFFFF
                        else:
                            g = (c + deltas[k]) & 0xFFFF
                        if g:
                            found.setdefault(c, g)
        return found

    def advance(self, g: int) -> int:
        return struct.unpack_from(">H", self.data, self.tables[b"hmtx"] + 4 * min(g, self.n_wide - 1))[0]

    def _glyph(self, g: int, depth: int = 0) -> list[np.ndarray]:
        """Contours as closed polygons in font units."""
        d, loca = self.data, self.tables[b"loca"]
        a, b = struct.unpack_from(">II", d, loca + 4 * g) if self.long else (2 * x for x in struct.unpack_from(">HH", d, loca + 2 * g))
        if a == b or depth > 5:
            return []
        at = self.tables[b"glyf"] + a
        n = struct.unpack_from(">h", d, at)[0]
        at += 10
        return self._parts(at, depth) if n < 0 else self._simple(at, n)

    def _parts(self, at: int, depth: int) -> list[np.ndarray]:
        d, out, more = self.data, [], True
        while more:
            flags, g = struct.unpack_from(">HH", d, at)
            x, y = struct.unpack_from(">hh" if flags & 1 else ">bb", d, at + 4)
            at += 8 if flags & 1 else 6
            m = np.eye(2)
            if flags & 8:
                m *= struct.unpack_from(">h", d, at)[0] / 16384
                at += 2
            elif flags & 0x40:
                m = np.diag([v / 16384 for v in struct.unpack_from(">hh", d, at)])
                at += 4
            elif flags & 0x80:
                m = np.array(struct.unpack_from(">4h", d, at)).reshape(2, 2) / 16384
                at += 8
            move = np.array([x, y]) if flags & 2 else np.zeros(2)
            out += [c @ m + move for c in self._glyph(g, depth + 1)]
            more = bool(flags & 0x20)
        return out

    def _simple(self, at: int, n: int) -> list[np.ndarray]:
        d = self.data
        ends = struct.unpack_from(f">{n}H", d, at)
        at += 2 * n
        at += 2 + struct.unpack_from(">H", d, at)[0]
        count, flags = (ends[-1] + 1 if n else 0), []
        while len(flags) < count:
            f = d[at]
            at += 1
            again = 0
            if f & 8:
                again = d[at]
                at += 1
            flags += [f] * (again + 1)
        axes = []
        for short, same in ((2, 16), (4, 32)):
            v, out = 0, []
            for f in flags:
                if f & short:
                    v += d[at] if f & same else -d[at]
                    at += 1
                elif not f & same:
                    v += struct.unpack_from(">h", d, at)[0]
                    at += 2
                out.append(v)
            axes.append(out)
        points, on = np.array(axes, float).T, [bool(f & 1) for f in flags]
        contours, first = [], 0
        for e in ends:
            if e > first:
                contours.append(_flat(points[first : e + 1], on[first : e + 1]))
            first = e + 1
        return contours


def _flat(p: np.ndarray, on: list[bool], steps: int = 5) -> np.ndarray:
    """Quadratic curves as lines: two control points in a row have a point between them."""
    full, kinds = [], []
    for i in range(len(p)):
        full.append(p[i])
        kinds.append(on[i])
        j = (i + 1) % len(p)
        if not on[i] and not on[j]:
            full.append((p[i] + p[j]) / 2)
            kinds.append(True)
    s = kinds.index(True)
    full, kinds = full[s:] + full[:s], kinds[s:] + kinds[:s]
    out = []
    for i, (q, k) in enumerate(zip(full, kinds, strict=True)):
        if k:
            out.append(q)
        else:
            a, b = full[i - 1], full[(i + 1) % len(full)]
            out += [(1 - t) ** 2 * a + 2 * t * (1 - t) * q + t * t * b for t in np.arange(1, steps) / steps]
    return np.array(out)


@functools.cache
def _forms() -> dict[int, dict[str, int]]:
    """Presentation forms of Arabic letters by kind, from the decompositions of Unicode."""
    out: dict[int, dict[str, int]] = {}
    for c in [*range(0xFB50, 0xFE00), *range(0xFE70, 0xFF00)]:
        kind, _, rest = unicodedata.decomposition(chr(c)).partition(" ")
        if kind in ("<initial>", "<medial>", "<final>", "<isolated>") and rest and " " not in rest:
            out.setdefault(int(rest, 16), {})[kind[1:-1]] = c
    return out


@functools.cache
def _members(kind: str) -> frozenset[int]:
    return frozenset(members(list(class_ranges(kind))))


def shaped(text: str) -> list[int]:
    """Code points in the order in which they stand from left to right. Arabic letters become the form that their neighbours ask for; if there is Arabic, the line runs from the right and runs of other letters and digits keep their order."""
    points = [ord(c) for c in text]
    letters, joining, marks = _members("AL"), _members("JOIN"), _members("M")
    base = [i for i, c in enumerate(points) if c not in marks]
    out = list(points)
    for k, i in enumerate(base):
        forms = _forms().get(points[i])
        if not forms:
            continue
        before = k > 0 and (points[base[k - 1]] in joining or points[base[k - 1]] == 0x640)
        after = k + 1 < len(base) and (points[base[k + 1]] in letters or points[base[k + 1]] == 0x640) and points[i] in joining
        out[i] = forms.get({(True, True): "medial", (True, False): "final", (False, True): "initial", (False, False): "isolated"}[before, after], points[i])
    if not any(c in letters for c in points):
        return out
    kinds = [unicodedata.bidirectional(chr(c)) for c in out]
    strong = [i for i, k in enumerate(kinds) if k in ("L", "EN", "AN", "AL", "R")]
    left = [k in ("L", "EN", "AN") for k in kinds]
    for i, j in zip(strong, strong[1:], strict=False):
        if left[i] and left[j]:
            left[i:j] = [True] * (j - i)  # what stands between two of a run belongs to it
    runs: list[list[int]] = []
    for i, c in enumerate(out):
        if left[i] and i and left[i - 1]:
            runs[-1].append(c)
        else:
            runs.append([c])
    return [c for run in reversed(runs) for c in run]


def fill(polygons: list[np.ndarray], height: int, width: int) -> np.ndarray:
    """Coverage from 0 to 1 by nonzero winding, OVER samples a pixel each way."""
    h, w = height * OVER, width * OVER
    turn = np.zeros((h, w + 1), np.int32)
    if polygons:
        start = np.concatenate(polygons) * OVER
        end = np.concatenate([np.roll(p, -1, axis=0) for p in polygons]) * OVER
        up = start[:, 1] > end[:, 1]
        (x0, y0), (x1, y1) = np.where(up[:, None], end, start).T, np.where(up[:, None], start, end).T
        low, high = (np.clip(np.ceil(y - 0.5), 0, h).astype(int) for y in (y0, y1))
        n = high - low  # sample rows that each edge crosses
        i = np.repeat(np.arange(len(n)), n)
        ys = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[i]
        xs = x0[i] + (ys + 0.5 - y0[i]) * (x1[i] - x0[i]) / (y1[i] - y0[i])
        np.add.at(turn, (ys, np.clip(np.ceil(xs - 0.5), 0, w).astype(int)), np.where(up, -1, 1)[i])
    inside = np.cumsum(turn, axis=1)[:, :w] != 0
    return inside.reshape(height, OVER, width, OVER).mean(axis=(1, 3))


def measure(font: Font, text: str, size: float, word: float = 0, letter: float = 0) -> float:
    return _place(font, text, size, word, letter)[1]


def fitted(font: Font, text: str, size: int, room: float, word: float = 0, letter: float = 0, step: int = 1, least: int = 14) -> int:
    """The size, made smaller by steps until the text fits or it would fall below `least`; a length is a linear function of the size."""
    fixed = measure(font, text, 0, word, letter)
    each = measure(font, text, 1000, word, letter) / 1000 - fixed / 1000
    while size - step >= least and each * size + fixed > room:
        size -= step
    return size


def _place(font: Font, text: str, size: float, word: float, letter: float):
    x, placed, scale, marks = 0.0, [], size / font.em, _members("M")
    for c in shaped(text):
        g = font.chars.get(c, 0)
        placed.append((g, x - (font.advance(g) * scale if c in marks else 0)))
        if c not in marks:
            x += font.advance(g) * scale + letter + (word if c == 32 else 0)
    return placed, x


def draw(font: Font, text: str, height: int, width: int, size: float, ink, paper, pad_x: int, opacity: float = 1.0, word: float = 0, letter: float = 0, least: int = 14) -> tuple[np.ndarray, int]:
    """(RGB pixels, the size used) of a line: the size shrinks by one until the text fits, down to `least`. Text with Arabic starts at the right edge."""
    size = fitted(font, text, int(size), width - 2 * pad_x, word, letter, 1, least)
    placed, length = _place(font, text, size, word, letter)
    scale = size / font.em
    start = width - pad_x - length if any(ord(c) in _members("AL") for c in text) else pad_x
    base = (height - (font.up - font.down) * scale) / 2 + font.up * scale
    polygons = [c * [scale, -scale] + [start + x, base] for g, x in placed for c in font.glyph(g)]
    cover = fill(polygons, height, width)[:, :, None] * opacity
    return np.rint(np.array(paper) * (1 - cover) + np.array(ink) * cover).astype(np.uint8), size
