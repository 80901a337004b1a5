"""Scan damage on pixels: NumPy functions from an RGB uint8 array and a Generator to an RGB uint8 array."""

from __future__ import annotations

import numpy as np

from . import jpeg as coder

LUMA = np.array([0.299, 0.587, 0.114])
WHITE = np.full(3, 255.0)


def clip(a: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(a), 0, 255).astype(np.uint8)


def gray(a: np.ndarray) -> np.ndarray:
    return a @ LUMA


def rgb(g: np.ndarray) -> np.ndarray:
    return np.repeat(clip(g)[:, :, None], 3, axis=2)


def convolve(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Separable, with edges repeated."""
    out = a.astype(float)
    r = len(kernel) // 2
    for axis in (0, 1):
        pad = [(0, 0)] * out.ndim
        pad[axis] = (r, r)
        padded = np.pad(out, pad, mode="edge")
        n = out.shape[axis]
        out = sum(k * np.take(padded, range(i, i + n), axis=axis) for i, k in enumerate(kernel))
    return out


def gauss(sigma: float, radius: int | None = None) -> np.ndarray:
    r = radius or max(1, int(np.ceil(3 * sigma)))
    k = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma * sigma))
    return k / k.sum()


def blur(a, sigma: float):
    return clip(convolve(a, gauss(sigma)))


#: Fixed: from where to where noise and bands are drawn.
NOISE, BAND = (1.6, 5.5), (3.0, 9.0)


def blur3(a):
    return clip(convolve(a, np.array([0.25, 0.5, 0.25])))


def unsharp(a, amount: float, threshold: float = 2):
    d = a - convolve(a, gauss(1.0))
    return clip(a + np.where(abs(d) >= threshold, d * amount, 0))


def extreme(a, height: int, width: int, darkest: bool, back: bool = False):
    """Least or greatest value in a window; least thickens dark ink. Windows of even size reach one further to the left and top, or with `back` to the right and bottom."""
    f = np.minimum if darkest else np.maximum
    before = [(n - 1) // 2 if back else n // 2 for n in (height, width)]
    pad = [(before[0], height - 1 - before[0]), (before[1], width - 1 - before[1])] + [(0, 0)] * (a.ndim - 2)
    p, out = np.pad(a, pad, mode="edge"), None
    for y in range(height):
        for x in range(width):
            v = p[y : y + a.shape[0], x : x + a.shape[1]]
            out = v if out is None else f(out, v)
    return out


def _area(n: int, m: int) -> np.ndarray:
    """(m, n) weights of an area mean from n samples to m."""
    edges = np.linspace(0, n, m + 1)
    i = np.arange(n)
    w = np.clip(np.minimum(edges[1:, None], i + 1) - np.maximum(edges[:-1, None], i), 0, None)
    return w / w.sum(axis=1, keepdims=True)


def _cubic(n: int, m: int) -> np.ndarray:
    """(m, n) weights of Keys' cubic kernel, a = -0.75, with edges repeated."""
    at = (np.arange(m) + 0.5) * n / m - 0.5
    base, w, a = np.floor(at).astype(int), np.zeros((m, n)), -0.75
    for k in range(-1, 3):
        t = abs(at - (base + k))
        v = np.where(t <= 1, (a + 2) * t**3 - (a + 3) * t**2 + 1, np.where(t < 2, a * (t**3 - 5 * t**2 + 8 * t - 4), 0))
        np.add.at(w, (np.arange(m), np.clip(base + k, 0, n - 1)), v)
    return w


def resize(a, height: int, width: int, how: str):
    height, width = max(1, height), max(1, width)
    if how == "nearest":
        y = (np.arange(height) * a.shape[0] / height).astype(int)
        return a[y][:, (np.arange(width) * a.shape[1] / width).astype(int)]
    make = _area if how == "area" else _cubic
    return clip(np.einsum("yh,hw...,xw->yx...", make(a.shape[0], height), a.astype(float), make(a.shape[1], width), optimize=True))


def closed(a, height: int, width: int):
    """Dark strokes thickened and thinned again: gaps up to the window are filled."""
    return extreme(extreme(a, height, width, True), height, width, False, True)


def paper(a, rng, strength: float):
    h, w = a.shape[:2]
    shade = np.linspace(rng.uniform(-10, 10), rng.uniform(-10, 10), w)[None, :] + np.linspace(rng.uniform(-8, 8), rng.uniform(-8, 8), h)[:, None]
    return clip(a + np.rint(shade + rng.normal(0, 4, (h, w)) * rng.uniform(0, strength))[:, :, None])


def noise(a, rng, sigma: float | None = None):
    return clip(a + np.rint(rng.normal(0, rng.uniform(*NOISE) if sigma is None else sigma, a.shape)))


def band(a, rng, amplitude: float | None = None):
    y, x = np.mgrid[: a.shape[0], : a.shape[1]]
    angle = rng.uniform(0, np.pi)
    wave = np.sin(2 * np.pi * rng.uniform(0.015, 0.055) * (x * np.cos(angle) + y * np.sin(angle)))
    return clip(a + (rng.uniform(*BAND) if amplitude is None else amplitude) * wave[:, :, None])


def between(rng, low: int, high: int) -> int:
    """Both ends included; at least the lower one."""
    return int(rng.integers(low, max(low, high) + 1))


def shadow(a, rng):
    w = a.shape[1]
    ramp = np.zeros(w)
    wide = between(rng, max(2, w // 28), max(3, w // 10))
    ramp[:wide] = np.linspace(rng.uniform(10, 36), 0, wide)[:w]
    return clip(a - (ramp if rng.random() < 0.5 else ramp[::-1])[None, :, None])


def stain(a, rng):
    """One or two brown ellipses, thinly laid over."""
    h, w = a.shape[:2]
    y, x = np.mgrid[:h, :w]
    out = a.astype(float)
    for _ in range(between(rng, 1, 2)):
        cx, cy = between(rng, 0, max(1, w)), between(rng, 0, max(1, h))
        rx, ry = between(rng, max(4, w // 30), max(6, w // 10)), between(rng, max(3, h // 6), max(4, h // 2))
        ink = [between(rng, *c) for c in ((130, 190), (105, 165), (55, 110))]
        alpha = between(rng, 8, 28) / 255
        inside = ((x - cx) / rx) ** 2 + ((y - cy) / ry) ** 2 <= 1
        out[inside] = out[inside] * (1 - alpha) + np.array(ink) * alpha
    return clip(out)


def rule(a, rng):
    """A piece of a ruled line near an edge."""
    h, w = a.shape[:2]
    out, ink, thick = a.copy(), int(rng.choice((0, 70, 135, 185))), int(rng.choice((1, 1, 2)))
    across = rng.random() < 0.7
    n, part = (h, 5) if across else (w, 12)
    at = between(rng, 0, n // part) if rng.random() < 0.5 else between(rng, max(0, n - n // part), max(0, n - 1))
    if across:
        left = between(rng, 0, w // 6)
        out[at : at + thick, left : between(rng, max(left + 8, w * 2 // 3), w) + 1] = ink
    else:
        out[:, at : at + thick] = ink
    return out


def local_threshold(a, block: int = 25, c: float = 8):
    """Black where darker than the Gaussian mean around it less c, else white."""
    g = gray(a)
    return rgb(np.where(np.rint(g) > np.rint(convolve(g, gauss(0.3 * ((block - 1) * 0.5 - 1) + 0.8, block // 2))) - c, 255, 0))


def soft(a, sigma: float):
    """Blurred in a window of 3 by 3."""
    return clip(convolve(a, gauss(sigma, 1)))


#: Fixed: windows and rounds by which a copier thickens strokes, from each intensity on.
SWELL = ((0.0, (1, 2, 2), (1,)), (0.35, (2, 2, 3), (1, 1, 2)), (0.7, (2, 3, 3), (1, 2, 2)))


def photocopy(a, rng, intensity: float):
    """Only black and white, swollen, at a lower resolution and back with hard edges."""
    x = min(1.0, max(0.0, intensity))
    h, w = a.shape[:2]
    if rng.random() < 0.65:
        g = np.where(np.rint(gray(a)) > between(rng, int(162 + 18 * x), int(196 + 28 * x)), 255, 0)
    else:
        g = local_threshold(a, int(rng.choice((17, 21, 25, 31))), between(rng, max(1, int(8 - 5 * x)), max(2, int(12 - 6 * x))))[:, :, 0].astype(int)
    _, windows, rounds = [s for s in SWELL if x >= s[0]][-1]
    k = int(rng.choice(windows))
    for _ in range(int(rng.choice(rounds))):
        g = extreme(g, k, k, True)
    f = rng.uniform(max(0.26, 0.58 - 0.28 * x), max(0.34, 0.82 - 0.24 * x))
    g = resize(resize(g, max(8, int(h * f)), max(8, int(w * f)), "area"), h, w, "nearest")
    if rng.random() < 0.25 + 0.35 * x:
        g = soft(g, rng.uniform(0.10, 0.55 + 0.35 * x))
    out = rgb(g)
    return noise(out, rng) if rng.random() < 0.20 + 0.35 * x else out


def bloat(a, rng, intensity: float):
    """Low resolution and only black and white, with strokes that run together and bitten edges."""
    x = min(1.0, max(0.0, intensity))
    h, w = a.shape[:2]
    f = max(0.42, min(0.96, 0.94 - 0.48 * x + rng.uniform(-0.02, 0.02)))
    g = resize(np.rint(gray(a)), max(8, int(h * f)), max(8, int(w * f)), "area")
    if x >= 0.18:
        g = soft(g, rng.uniform(0.05, 0.18 + 0.28 * x))
    dark = g[g < np.percentile(g, 84)]
    level = int(np.percentile(dark, 84 + 10 * x)) if dark.size else int(np.percentile(g, 35))
    v = np.where(g > max(80, min(235, level + round(5 + 34 * x) + between(rng, -2, 3))), 255, 0)
    if (bridge := 1 + round(8 * x)) > 1:
        v = closed(v, 1, bridge)
    if x >= 0.28:
        v = extreme(v, 1, max(2, 1 + round(3 * x)), True)
    if x >= 0.48:
        v = extreme(v, 2, 2, True)
    if x >= 0.34:
        v = closed(v, 2, 2)
    if rng.random() < 0.18 + 0.28 * x:
        edge = extreme(v, 2, 2, True) != extreme(v, 2, 2, False)
        v = np.where(edge & (rng.random(v.shape) < rng.uniform(0.010, 0.035 + 0.025 * x)), 255, v)
    return rgb(resize(v, h, w, "nearest"))


def _gather(a, y, x, ground):
    """Bilinear; ground outside."""
    h, w = a.shape[:2]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    out = np.zeros((*y.shape, a.shape[2]))
    for dy in (0, 1):
        for dx in (0, 1):
            yy, xx = y0 + dy, x0 + dx
            inside = (yy >= 0) & (yy < h) & (xx >= 0) & (xx < w)
            v = np.where(inside[..., None], a[np.clip(yy, 0, h - 1), np.clip(xx, 0, w - 1)], ground)
            out += v * ((1 - abs(y - yy)) * (1 - abs(x - xx)))[..., None]
    return clip(out)


def ground_of(a) -> np.ndarray:
    return np.median(np.concatenate([a[0], a[-1], a[:, 0], a[:, -1]]), axis=0)


def _padded(a, pad: int):
    h, w = a.shape[:2]
    out = np.full((h + 2 * pad, w + 2 * pad, a.shape[2]), 255, np.uint8)
    out[pad : pad + h, pad : pad + w] = a
    return out


def warp(a, rng, frac: float, pad: int):
    """Corners shifted by whole pixels, up to frac of the shorter side; white around, at least as far as corners can go."""
    h0, w0 = a.shape[:2]
    pad = max(pad, int(max(h0, w0) * frac * 2) + 6)
    p = _padded(a, pad)
    h, w = p.shape[:2]
    most = max(1, int(min(h0, w0) * frac))
    home = np.array([[pad, pad], [pad + w0, pad], [pad + w0, pad + h0], [pad, pad + h0]], float)
    moved = home + rng.integers(-most, most + 1, (4, 2))
    rows, right = [], []
    for (x, y), (u, v) in zip(moved, home, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    m = np.append(np.linalg.solve(np.array(rows), np.array(right)), 1).reshape(3, 3)
    y, x = np.mgrid[:h, :w]
    u, v, d = np.tensordot(m, np.stack([x, y, np.ones_like(x)]), 1)
    return _gather(p, v / d, u / d, WHITE)


def rotate(a, degrees: float, pad: int):
    """About the centre, on a white canvas that holds all of it; less than 0.05 degrees change nothing."""
    if abs(degrees) < 0.05:
        return a
    p, t = _padded(a, max(8, pad)), np.radians(degrees)
    h, w = p.shape[:2]
    c, s = np.cos(t), np.sin(t)
    hh, ww = int(np.ceil(abs(w * s) + abs(h * c))), int(np.ceil(abs(w * c) + abs(h * s)))
    y, x = np.mgrid[:hh, :ww]
    y, x = y - (hh - 1) / 2, x - (ww - 1) / 2
    return _gather(p, s * x + c * y + (h - 1) / 2, c * x - s * y + (w - 1) / 2, WHITE)


def morph(a, rng, how: str):
    """Ink, darker than 210, thickened, thinned or closed in a window of 2 by 2. New ink is nearly black, lost ink nearly white."""
    g = np.where(gray(a) < 210, 0, 255)
    grown = closed(g, 2, 2) if how == "close" else extreme(g, 2, 2, how == "thick")
    out = np.where((grown < g)[:, :, None], np.minimum(a, between(rng, 0, 45)), a)
    return np.where((grown > g)[:, :, None], np.maximum(a, between(rng, 225, 255)), out).astype(np.uint8)


def contrast(a, factor: float):
    return clip(gray(a).mean() + (a - gray(a).mean()) * factor)


def brightness(a, factor: float):
    return clip(a * factor)


def jpeg(a, quality: int):
    """What a JPEG of that quality does to pixels."""
    return coder.pixels(coder.coefficients(a, quality), quality, *a.shape[:2])


def trim(a, pad_x: int, pad_y: int):
    """Cut to the ink with that much around it. With fewer than 8 dark pixels, or less than 24 by 12 left, nothing is cut."""
    g = gray(a)
    ys, xs = np.nonzero(g < np.percentile(g, 92) - 18)
    if len(ys) < 8:
        return a
    out = a[max(0, ys.min() - pad_y) : ys.max() + pad_y + 1, max(0, xs.min() - pad_x) : xs.max() + pad_x + 1]
    return a if out.shape[1] < 24 or out.shape[0] < 12 else out


def profile(a, name: str, rng, intensity: float = 0.0):
    """The damage of a profile by itself; intensity: of photocopies and bloated prints."""
    chance = lambda p: rng.random() < p
    if name == "digital_clean":
        return paper(a, rng, 0.25) if chance(0.15) else a
    if name == "raster_pdf":
        h, w = a.shape[:2]
        f = float(rng.choice((0.82, 0.9, 1.15)))
        a = paper(resize(resize(a, int(h * f), int(w * f), "area"), h, w, "cubic"), rng, 0.35)
        return blur3(a) if chance(0.25) else a
    if name == "book_scan":
        a = paper(a, rng, 0.9)
        a = morph(a, rng, str(rng.choice(("thick", "thin", "close")))) if chance(0.35) else a
        return soft(a, rng.uniform(0.1, 0.5)) if chance(0.35) else a
    if name == "thick_scan":
        a = paper(morph(a, rng, "thick"), rng, 0.75)
        return blur3(a) if chance(0.30) else a
    if name == "thin_scan":
        return contrast(paper(morph(a, rng, "thin"), rng, 0.7), rng.uniform(0.72, 0.92))
    if name == "overcooked_scan":
        return paper(local_threshold(morph(a, rng, "close"), 25, between(rng, 4, 13)), rng, 0.5)
    if name == "photocopy_bleed":
        a = photocopy(a, rng, intensity)
        return paper(a, rng, 0.25) if chance(0.5) else a
    if name == "binary_lowres_bloat":
        return bloat(a, rng, intensity)
    if name == "faded_scan":
        return brightness(contrast(paper(a, rng, 1.0), rng.uniform(0.55, 0.78)), rng.uniform(1.03, 1.16))
    raise ValueError(f"unknown profile {name!r}")


def damage(a, plan: dict, seed: int, frac: float = 0.025, pad: int = 32):
    """All damage of a line by its row of sheets.damage_plan, in fixed order; browser_clean changes nothing."""
    name = plan["effective_profile"]
    if name == "browser_clean":
        return a
    rng = np.random.default_rng(seed)
    a = profile(a, name, rng, plan["intensity"] or 0.0)
    if plan["noise"]:
        a = noise(a, rng, plan["noise_sigma"])
    if plan["band"]:
        a = band(a, rng, plan["band_amplitude"])
    for gate, f in (("shadow", shadow), ("stain", stain), ("rule", rule)):
        if plan[gate]:
            a = f(a, rng)
    if plan["warp"]:
        a = warp(a, rng, frac, pad)
    if plan["rotate"]:
        a = rotate(a, plan["degrees"], pad)
    if plan["unsharp"]:
        a = unsharp(a, plan["unsharp_percent"] / 100)
    if plan["heavy_blur"]:
        a = blur(a, plan["blur_radius"])
    return jpeg(a, int(plan["jpeg_quality"]))
